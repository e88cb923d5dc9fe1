"""Canonical k-mer hashes and bottom sketches of ASCII sequences as arrays, and sketches as short byte strings
(``coded_sketches`` of ``operators/similarity.py``).

``hashes`` works on all k-mers of a block at once, a step of MD5 being a few whole-array operations: the first 60 bits of
md5, the same values as ``('0x' || substr(md5(kmer), 1, 15))::bigint``.

A sketch's code is exact and as short as its genome allows: the sequence itself (Huffman coded, about two bits a
letter) with a bit for every place that tells whether its k-mer is in the sketch, or, where that is longer, the hashes.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 15              # k-mers hashed at once (their words stay in a core's cache)
CHARS = 1 << 20              # letters (or letters of codes) taken at once
HASHES, PLACES = 0, 1        # kinds of codes

_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[list(b"ACGT")] = list(b"TGCA")
_K = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_S = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_AT = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_INIT = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_HEAD = struct.Struct("<BII")


def _block(state: list[np.ndarray], words: list) -> list[np.ndarray]:
    """One MD5 block; a word is an array, or a number where all messages have the same."""
    a, b, c, d = (x.copy() for x in state)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:                                               # d ^ (b & (c ^ d))
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:                                             # c ^ (d & (b ^ c))
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:                                             # b ^ c ^ d
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:                                                    # c ^ (b | ~d)
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        w = words[_AT[i]]
        np.add(f, a, out=f)
        if isinstance(w, int):
            np.add(f, np.uint32((_K[i] + w) & 0xFFFFFFFF), out=f)
        else:
            np.add(f, w, out=f)
            np.add(f, np.uint32(_K[i]), out=f)
        np.left_shift(f, np.uint32(_S[i]), out=t)
        np.right_shift(f, np.uint32(32 - _S[i]), out=f)
        np.bitwise_or(f, t, out=f)
        np.add(f, b, out=a)                                      # the old a is not needed any more
        a, b, c, d = d, a, b, c
    return [x + y for x, y in zip(state, (a, b, c, d))]


def hashes(seq: np.ndarray, k: int, places: np.ndarray | None = None) -> np.ndarray:
    """The first 60 bits of md5 of the canonical k-mers of ``seq`` (uint8) at ``places``, or at all."""
    n, end = len(seq), max(len(seq) - k + 1, 0)
    pad = np.zeros(8, np.uint8)
    fw, rv = np.concatenate([seq, pad]), np.concatenate([_COMPLEMENT[seq[::-1]], pad])
    words = lambda b, kind: np.ndarray(len(b) - 7, kind, b.data, 0, (1,))  # noqa: E731 - what stands in the bytes from every place on
    count = end if places is None else len(places)
    out = np.empty(count, np.int64)
    for lo in range(0, count, BLOCK):
        hi = min(lo + BLOCK, count)
        if places is None:                                       # the same k-mers from both strands
            f = lambda w, at: w[lo + at:hi + at]  # noqa: B023, E731
            r = lambda w, at: w[n - k - hi + 1 + at:n - k - lo + 1 + at][::-1]  # noqa: B023, E731
        else:
            p, q = places[lo:hi], n - k - places[lo:hi]
            f, r = (lambda w, at: w[p + at]), (lambda w, at: w[q + at])  # noqa: B023
        # k-mer or its reverse complement: the first bytes that differ decide, eight at once (the last ones overlap)
        steps = [*range(0, k - 7, 8), *([k - 8] if k % 8 else [])] if k >= 8 else range(k)
        less, equal = np.ones(hi - lo, bool), np.ones(hi - lo, bool)
        for at in steps:
            kind = ">u8" if k >= 8 else "u1"
            x, y = f(words(fw, kind), at).astype("u8"), r(words(rv, kind), at).astype("u8")
            less = np.where(equal, x <= y, less)
            equal &= x == y
        message: list = []
        for at in range(0, k, 4):
            w = np.where(less, f(words(fw, "<u4"), at), r(words(rv, "<u4"), at))
            rest = 8 * (k - at)
            message.append(w if rest >= 32 else (w & np.uint32((1 << rest) - 1)) | np.uint32(0x80 << rest))
        message += [0x80] * (k % 4 == 0)
        message += [0] * (-(len(message) + 2) % 16) + [8 * k & 0xFFFFFFFF, 8 * k >> 32]
        state = [np.full(hi - lo, x, np.uint32) for x in _INIT]
        for at in range(0, len(message), 16):
            state = _block(state, message[at:at + 16])
        high, low = (x.byteswap().astype(np.uint64) for x in state[:2])
        out[lo:hi] = (((high << np.uint64(32)) | low) >> np.uint64(4)).view(np.int64)
    return out


def _lowest(h: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """The s smallest distinct hashes, ascending, and a place of each."""
    share = (s + 6 * math.sqrt(s) + 20) / max(len(h), 1)         # about so many stand below it, were they even
    for at in ([np.flatnonzero(h <= int(share * float(1 << 60)))] if share < 1 else []) + [None]:
        few = h if at is None else h[at]
        if at is None or len(few) >= s:
            order = np.argsort(few, kind="stable")
            few = few[order]
            first = np.ones(len(few), bool)
            first[1:] = few[1:] != few[:-1]
            if at is None or first.sum() >= s:
                few, order = few[first][:s], order[first][:s]
                return few, order if at is None else at[order]
    raise AssertionError


def lowest(h: np.ndarray, s: int) -> np.ndarray:
    return np.unique(h)[:s]


def code_of_hashes(h: np.ndarray) -> bytes:
    return bytes([HASHES]) + np.ascontiguousarray(h, "<i8").tobytes()


def _slices(sizes: Sequence[int], limit: int = CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive items of about ``limit`` in all (one at least)."""
    a = size = 0
    for i, n in enumerate(sizes):
        if i > a and size + n > limit:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(sizes):
        yield a, len(sizes)


def codes_of_sequences(seqs: list[bytes], k: int, s: int) -> Iterator[tuple[bytes, int]]:
    """(code of the sketch, number of its hashes) of every sequence (of k letters at least)."""
    for a, b in _slices([len(x) for x in seqs]):
        h = hashes(np.frombuffer(b"".join(seqs[a:b]), np.uint8), k)
        at = 0
        for seq in seqs[a:b]:
            n = len(seq) - k + 1
            low, places = _lowest(h[at:at + n], s)
            at += len(seq)
            code = None
            if n // 8 + len(seq) // 8 < 8 * len(low):            # else a code of the letters can't be shorter
                bits = np.zeros(n, np.uint8)
                bits[places] = 1
                z = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
                code = _HEAD.pack(PLACES, k, len(seq)) + np.packbits(bits).tobytes() + z.compress(seq) + z.flush()
            if code is None or len(code) > 8 * len(low) + 1:
                code = code_of_hashes(low)
            yield code, len(low)


def decoded(codes: list[bytes]) -> list[np.ndarray]:
    """The hashes of every code, ascending."""
    out: list = [np.frombuffer(c, "<i8", offset=1) if c[0] == HASHES else None for c in codes]
    todo = [i for i, c in enumerate(codes) if c[0] == PLACES]
    heads = {i: _HEAD.unpack_from(codes[i]) for i in todo}
    for k in {h[1] for h in heads.values()}:
        of_k = [i for i in todo if heads[i][1] == k]
        for a, b in _slices([heads[i][2] for i in of_k]):
            seqs, places, start = [], [], 0
            for i in of_k[a:b]:
                length = heads[i][2]
                n = length - k + 1
                z = _HEAD.size + (n + 7) // 8
                bits = np.frombuffer(codes[i], np.uint8, z - _HEAD.size, _HEAD.size)
                places.append(np.flatnonzero(np.unpackbits(bits, count=n)) + start)
                seqs.append(zlib.decompress(codes[i][z:], -15))
                start += length
            h, at = hashes(np.frombuffer(b"".join(seqs), np.uint8), k, np.concatenate(places)), 0
            for i, p in zip(of_k[a:b], places):
                out[i] = np.sort(h[at:at + len(p)])
                at += len(p)
    return out


def jaccard(a: np.ndarray, b: np.ndarray, s: int) -> float | None:
    """|bottom_s(A u B) n A n B| / |bottom_s(A u B)| of ascending distinct hashes."""
    c = np.concatenate([a, b])
    c.sort(kind="stable")                                        # two runs: a merge
    twice = c[1:] == c[:-1]
    union = len(c) - int(twice.sum())
    if not union:
        return None
    both = c[1:][twice]
    if union <= s:
        return len(both) / union
    # the s-th distinct hash: those of both sides stand twice
    first = np.ones(len(c), bool)
    first[1:] = ~twice
    return int(np.searchsorted(both, c[np.flatnonzero(first)[s - 1]], "right")) / s

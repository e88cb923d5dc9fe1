"""Ids of a tokenizer file that works inside runs between white space, each distinct run of a stretch encoded once.

Such a tokenizer (normalise, split into words, merge inside a word) gives a text the ids of its runs, one after the
other: nothing it does reaches across a blank, a tab or a line end.  The same holds for a cut between an ASCII
letter and an ASCII sign before or behind it (but ``'``, ``<``, ``|``, ``>`` and the signs of added tokens), and case
doesn't matter to a tokenizer that lowers it.  So a stretch of texts is cut into runs as one array of bytes, its
distinct runs are looked up among those the task has met, bounded in number, and the tokenizers library encodes the
others, many in one call.  The tests compare the ids with those of whole texts.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

BREAK = "\ue000"                      # private-use character that stands between runs in one call
RUNS, CORES, CALL = 400_000, 600_000, 4000
STRETCH = 4_000_000                   # characters whose runs are told apart at once
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")     # letters that every step keeps as letters: one word with one end


def _bytes(chars: bytes) -> np.ndarray:
    """A table over all bytes: whether it is one of ``chars``."""
    return np.isin(np.arange(256), list(chars))


_BLANK, _SIGN = _bytes(b" \n\t\r"), _bytes(rb"!\"#$%&()*+,-./:;=?@[\]^_`{}~")
_LETTER = _bytes(bytes([*range(65, 91), *range(97, 123)]))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_MARK = _bytes(b"\xcc\xcd")           # lead bytes of U+0300 to U+036F, which may join the letter before them


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, runs: int = RUNS, cores: int = CORES) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.mark = self._plain(BREAK)
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        self.ends = np.zeros(max(words.values()) + 1, bool)      # ids that end a word
        if suffix:
            self.ends[[i for w, i in words.items() if w.endswith(suffix)]] = True
        self.parts = bool(self.ends.any())
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.sign = _SIGN & ~_bytes(added.encode())
        self.most_runs, self.most_cores = runs, cores
        self.cores: dict[str, bytes] = {}        # words of letters only
        self.runs: dict[str, bytes] = {}         # other runs: numbers and addresses seldom come back and displace no words

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _words(self, new: list[str]) -> dict[str, bytes]:
        """Ids of words of letters, many in a call, told apart by ids that end a word."""
        out: dict[str, bytes] = {}
        for i in range(0, len(new), CALL):
            ids = self._plain(" ".join(new[i:i + CALL]))
            at = np.flatnonzero(self.ends[ids]) + 1
            out.update(_parted(new[i:i + CALL], ids, np.r_[0, at[:-1]], at))
        return out

    def _others(self, new: list[str]) -> dict[str, bytes]:
        """Ids of runs without blanks, many in a call, told apart by a mark between them."""
        out = {w: self._plain(w).tobytes() for w in new if BREAK in w}
        new = [w for w in new if BREAK not in w]
        for i in range(0, len(new), CALL):
            ids = self._plain(f" {BREAK} ".join(new[i:i + CALL]))
            hit = np.ones(max(0, len(ids) - len(self.mark) + 1), bool)
            for k, m in enumerate(self.mark):
                hit &= ids[k:k + len(hit)] == m
            at = np.flatnonzero(hit)
            out.update(_parted(new[i:i + CALL], ids, np.r_[0, at + len(self.mark)], np.r_[at, len(ids)]))
        return out

    def _known(self, runs: list[str]) -> list[bytes]:
        """Ids of distinct runs; those met for the first time are encoded and kept."""
        found = list(map(self.cores.get, runs))
        at = [i for i, x in enumerate(found) if x is None]
        words, others = [], []
        for i in at:
            w = runs[i]
            if self.parts and _WORD.fullmatch(w):
                words.append(w)
            else:
                found[i] = self.runs.get(w)
                if found[i] is None:
                    others.append(w)
        new = self._words(words)
        _keep(self.cores, new, self.most_cores)
        more = self._others(others)
        _keep(self.runs, more, self.most_runs)
        new.update(more)
        for i in at:
            if found[i] is None:
                found[i] = new[runs[i]]
        return found

    def _cut(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The runs of all texts, one after the other, and how many of them each text and those before it have."""
        raw = np.frombuffer(" ".join([*texts, ""]).encode(), np.uint8)
        size = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
        blank = _BLANK[raw]
        first = ~blank
        letter, sign = _LETTER[raw], self.sign[raw]
        first[1:] &= blank[:-1] | letter[:-1] & sign[1:] | sign[:-1] & letter[1:]
        ends = np.searchsorted(np.flatnonzero(first), np.cumsum(size + 1))
        solid = ~blank
        starts, held = np.flatnonzero(first[solid]), raw[solid]
        starts = np.append(starts, len(held))
        if self.lowers:
            held = _kept_case(held, _LOWER[held], starts)
        runs = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(held))
        return runs.dictionary_encode(), ends

    def stretch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's end."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        runs, ends = self._cut(texts)
        known = self._known(runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start, of = np.cumsum(length) - length, runs.indices.to_numpy()
        last = np.cumsum(length[of])
        at = np.repeat(start[of] - last + length[of], length[of])
        at += np.arange(len(at))
        return np.frombuffer(b"".join(known), "<u4")[at], np.append(0, last)[ends]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.stretch(texts)
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _kept_case(held: np.ndarray, lower: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``lower``, but as in ``held`` in runs where case may matter: a mark may join its letter, ``<|`` may begin a token of its own."""
    odd = _MARK[held]
    odd[1:] |= (held[1:] == ord("|")) & (held[:-1] == ord("<"))
    if not odd.any():
        return lower
    cased = np.zeros(len(starts) - 1, bool)
    cased[np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1] = True
    return np.where(np.repeat(cased, np.diff(starts)), held, lower)


def _parted(runs: list[str], ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> zip:
    """Runs with the bytes of their ids."""
    if len(first) != len(runs):
        raise ValueError("the tokenizer joins or parts runs unlike white space does")
    raw = ids.tobytes()
    return zip(runs, map(raw.__getitem__, map(slice, (4 * first).tolist(), (4 * last).tolist())), strict=True)


def _keep(known: dict[str, bytes], new: dict[str, bytes], most: int) -> None:
    """Add ``new`` to ``known``, which never holds more than ``most``: it begins anew when full."""
    if len(known) + len(new) > most:
        known.clear()
    if len(new) <= most:
        known.update(new)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)

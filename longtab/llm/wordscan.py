"""Words of many texts at once as numpy arrays: letter runs, scripts, lower-cased code points and
rolling hashes.  Language ID and toxicity share this scan; no Python code runs per word."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Script ranges (first code point, script); a range lasts until the next entry.  Fixed values from the
# Unicode block list; "other" takes every letter of a block that is not named.
SCRIPTS = ("other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian",
           "hangul", "kana", "han")
RANGES = ((0, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"),
          (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"), (0x900, "indic"), (0xE00, "thai"),
          (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1C80, "cyrillic"),
          (0x1C90, "georgian"), (0x1CC0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
          (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"),
          (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
          (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"),
          (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
          (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
          (0xFF00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"),
          (0x20000, "han"), (0x32000, "other"))


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(letter table: 0 or 1 + script index; lower-case table) over all code points, built once a worker."""
    starts = [a for a, _ in RANGES]
    kind = np.zeros(0x110000, dtype=np.uint8)
    for (a, name), b in zip(RANGES, [*starts[1:], 0x110000], strict=True):
        kind[a:b] = 1 + SCRIPTS.index(name)
    letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    low = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letter):
        x = chr(i).lower()
        if len(x) == 1:
            low[i] = ord(x)
    return np.where(letter, kind, 0).astype(np.uint8), low


@dataclass
class Words:
    codes: np.ndarray    # lower-cased code points of all texts, texts separated by one newline
    letter: np.ndarray   # positions of letters in codes
    script: np.ndarray   # script index of each letter
    start: np.ndarray    # first position of each word in codes
    length: np.ndarray   # letters of each word
    first: np.ndarray    # index of each word's first letter in ``letter``
    doc: np.ndarray      # text of each word
    base: np.ndarray     # position of each text's first character in codes


def scan(texts: list[str]) -> Words:
    """Letter runs of all texts (maximal runs of Unicode letters)."""
    kinds, low = tables()
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    base = np.zeros(len(texts), dtype=np.int64)
    if len(texts) > 1:
        base[1:] = np.cumsum([len(t) + 1 for t in texts[:-1]])
    kind = kinds[raw]
    is_letter = kind > 0
    edge = np.flatnonzero(np.diff(is_letter.astype(np.int8), prepend=0, append=0))
    start, end = edge[0::2], edge[1::2]
    letter = np.flatnonzero(is_letter)
    length = end - start
    first = np.cumsum(length) - length
    doc = np.searchsorted(base, start, side="right") - 1
    return Words(np.where(is_letter, low[raw], raw), letter, kind[letter] - 1, start, length, first, doc, base)


MIX = np.uint64(0x9E3779B97F4A7C15)


def bucket(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Multiplicative hash of uint64 values to ``bits`` bits."""
    with np.errstate(over="ignore"):
        h = (h ^ np.uint64(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * MIX
        h ^= h >> np.uint64(29)
        return ((h * MIX) >> np.uint64(64 - bits)).astype(np.int64)


@lru_cache(maxsize=1)
def powers() -> np.ndarray:
    p, out = 1, []
    for _ in range(4096):
        out.append(p)
        p = p * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return np.array(out, dtype=np.uint64)


def word_hash(w: Words) -> np.ndarray:
    """A 64-bit hash of each whole lower-cased word."""
    if not len(w.start):
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(len(w.letter)) - np.repeat(w.first, w.length)
    with np.errstate(over="ignore"):
        x = (w.codes[w.letter].astype(np.uint64) + np.uint64(1)) * powers()[at & 4095]
        return np.add.reduceat(x, w.first) + w.length.astype(np.uint64)


def affix_hash(w: Words, n: int, suffix: bool = False) -> np.ndarray:
    """A hash of the first (or last) ``n`` letters; of the whole word where it is shorter."""
    h = np.zeros(len(w.start), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            at = w.start + (w.length - 1 - j if suffix else j)
            x = w.codes[np.clip(at, 0, len(w.codes) - 1)].astype(np.uint64) + np.uint64(1)
            h = np.where(j < w.length, h * np.uint64(0x100000001B3) + x, h)
    return h

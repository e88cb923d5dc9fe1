"""Fill-in-middle transformation with a Fenwick tree over text blocks (operator 11).

A text is cut at two unit boundaries into prefix, middle and suffix, which are then written in another
order with sentinels.  A unit is a code point, or whatever a pattern matches, left to right.

Where the k-th unit ends is found through blocks of ``BLOCK`` bytes of the UTF-8 text: a Fenwick tree holds
how many units end in each block and how many code points start there.  Descending it by powers of two gives
the block in which the k-th unit ends, with the units and code points before that block; the boundary itself is
then located inside that one block.  So both cuts, whatever the unit is, come from one pass over the bytes,
and no list of code points or units is made for the whole text.

Cuts and form are drawn from SHA-256 of (seed, id), so reruns agree.  A text is left plain if it is empty, if it
holds a sentinel (its parts could not be told apart again) or if its draw says so.

Null text is an empty text; a null id is written as the empty string.  Repeated rows are transformed alike, each
for itself; other columns don't matter, whatever they are called.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longtab.llm.common import map_batches

BLOCK = 1024                      # bytes of a block
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_SHARE, SPM_SHARE = 1, 90, 20
FORMS = ("plain", "psm", "spm")


class Fenwick:
    """Prefix sums of several counts for each block, with a descent by the first of them."""

    def __init__(self, counts: np.ndarray) -> None:
        """``counts`` [blocks, kinds]; node i (from 1) holds the sums of the blocks (i - lowbit(i), i]."""
        n = len(counts)
        sums = np.vstack([np.zeros((1, counts.shape[1]), np.int64), np.cumsum(counts, axis=0, dtype=np.int64)])
        at = np.arange(1, n + 1)
        self.size, self.node = n, np.vstack([sums[:1], sums[at] - sums[at - (at & -at)]])

    def descend(self, k: int) -> tuple[int, np.ndarray]:
        """(block, sums before it) of the block that holds the k-th (from 1) item of the first kind."""
        at, before = 0, np.zeros(self.node.shape[1], np.int64)
        step = 1 << max(self.size.bit_length() - 1, 0)
        while step:
            to = at + step
            if to <= self.size and before[0] + self.node[to, 0] < k:
                at, before = to, before + self.node[to]
            step >>= 1
        return at, before


def unit_ends(data: bytes, pattern: str | None) -> np.ndarray | None:
    """Byte offsets of the last byte of each unit; None for code points, whose starts tell it as well."""
    if pattern is None:
        return None
    text = data.decode("utf-8")
    ends = np.fromiter((m.end() for m in re.finditer(pattern, text, re.S) if m.end() > m.start()), dtype=np.int64)
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.r_[starts, len(data)][ends] - 1


class Blocks:
    """Counts of one text: units (by their last byte) and code points (by their first) of every block."""

    def __init__(self, data: bytes, pattern: str | None = None, block: int = BLOCK) -> None:
        self.data, self.block = data, block
        raw = np.frombuffer(data, np.uint8)
        starts = (raw & 0xC0) != 0x80
        if pattern is None:
            last = np.empty_like(starts)
            last[:-1], last[-1:] = starts[1:], True
        else:
            last = np.zeros(len(raw), bool)
            last[unit_ends(data, pattern)] = True
        self.starts, self.last = starts, last
        edges = np.arange(0, len(raw), block)
        counts = np.stack([np.add.reduceat(x.view(np.uint8), edges, dtype=np.int64) for x in (last, starts)], axis=1) if len(
            raw) else np.zeros((0, 2), np.int64)
        self.units, self.points = (int(x) for x in counts.sum(axis=0))
        self.tree = Fenwick(counts)

    def cut(self, k: int) -> tuple[int, int]:
        """(byte offset, code points before it) of the boundary after the k-th unit; k = 0 is the start."""
        if k <= 0:
            return 0, 0
        b, (units, points) = self.tree.descend(k)
        a = b * self.block
        inside = int(np.flatnonzero(self.last[a:a + self.block])[k - int(units) - 1]) + 1
        return a + inside, int(points) + int(self.starts[a:a + inside].sum())


@dataclass(frozen=True)
class Plan:
    """What a row's draw says."""
    low: int
    high: int
    form: str


def draw(doc_id: int | None, units: int, seed: int = SEED, share: int = FIM_SHARE, spm: int = SPM_SHARE) -> Plan:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (units + 1), h2 % (units + 1)))
    return Plan(a, b, "plain" if h3 % 100 >= share else "spm" if h4 % 100 < spm else "psm")


def rearrange(doc_id: int | None, data: bytes, pattern: str | None = None, block: int = BLOCK) -> dict:
    """One text: form, units, code points of prefix and middle (None if plain) and the output bytes."""
    blocks = Blocks(data, pattern, block)
    plan = draw(doc_id, blocks.units)
    marks = [x.encode() for x in (PREFIX, SUFFIX, MIDDLE)]
    if not data or plan.form == "plain" or any(m in data for m in marks):
        return {"n": blocks.units, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": data}
    (i, p), (j, q) = blocks.cut(plan.low), blocks.cut(plan.high)
    prefix, middle, suffix = data[:i], data[i:j], data[j:]
    first, second = (marks[0] + prefix, marks[1] + suffix)
    out = first + second if plan.form == "psm" else second + first
    return {"n": blocks.units, "form": plan.form, "prefix_chars": p, "middle_chars": q - p, "output": out + marks[2] + middle}


def rearranged(docs: DataFrame, pattern: str | None = None, block: int = BLOCK) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n, form, prefix_chars, middle_chars, output): n units, and the text as written.

    ``pattern`` matches a unit (None: a code point); text between and after matches belongs to the part it stands in."""
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batch):
        ids = batch.column("doc_id").to_pylist()
        raw = batch.column("text").cast(pa.binary()).to_pylist()
        rows = [rearrange(i, t or b"", pattern, block) for i, t in zip(ids, raw, strict=True)]
        out = {n: pa.array([r[n] for r in rows], pa.binary() if n == "output" else t) for n, t in zip(names, types, strict=True)}
        return {"doc_id": batch.column("doc_id")} | out | {"output": out["output"].cast(pa.string())}
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again, from what was written and its form alone: the sentinels occur once each, so the output splits there."""
    part = F.split(F.col(output), "<[PSM]>", -1)
    get = lambda i: F.get(part, F.lit(i))
    return (F.when(F.col(form) == "psm", F.concat(get(1), get(3), get(2)))
            .when(F.col(form) == "spm", F.concat(get(2), get(3), get(1))).otherwise(F.col(output)))


def digests(docs: DataFrame, pattern: str | None = None) -> DataFrame:
    """``rearranged`` with SHA-256 of the output and of the text restored from it, in place of the texts."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rearranged(docs, pattern).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored()).alias("restored_sha256"))

"""Best-fit packing of token sequences by bin completion (operator 3).

Documents are tokenised in tasks; longer ones than the capacity are cut so that only the first piece may
be shorter.  Packing does not need the documents, only how many pieces there are of each length: a
table of at most ``capacity`` rows, whatever the corpus' size.  Bin completion works on that table: a
best-fit-decreasing solution is the incumbent; then branch-and-bound takes the longest remaining piece,
enumerates undominated fillings around it (no filling whose pieces fit inside another's), uses a filling
as often as the counts allow, and prunes a branch whose waste shows that it needs as many sequences as
the incumbent.  The result is a list of patterns with multiplicities (at most a few per length).

Pieces then take their places in Spark: pieces of one length are numbered in chunks (count per chunk,
prefix sum, number inside the chunk), and a number maps to a pattern, a sequence and an offset by binary
search, so no length, however common, is in one task.

Null and empty texts are one closing token (id 0).  Repeated rows are pieces of their own.
"""

from __future__ import annotations

import base64
import bisect
import json
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.common import map_batches, texts_of
from longtab.session import cut_lineage

CAPACITY = 2048
CHUNK_ROWS = 500
# Search bounds of the branch-and-bound; the incumbent stands when they are reached.
NODES, FILLINGS, STEPS = 6000, 4, 160


Added = tuple[tuple[str, int], ...]   # strings that are tokens of their own, with their ids


@lru_cache(maxsize=2)
def added_tokens(json_path: str) -> Added:
    """The added tokens that a tokenizer file declares."""
    with open(json_path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(t[k] for t in found for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of {json_path} do not stand for their plain strings")
    return tuple((t["content"], t["id"]) for t in found)


@lru_cache(maxsize=2)
def encoder(ranks_path: str, added: Added = ()):
    """Encoder of the vocabulary as ranks: the ids of the tokenizer file, several times faster (the tests compare them).
    Only strings in ``added`` are tokens of their own; without it they are ordinary text."""
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(added))


def token_ids(text: str, ranks_path: str, added: Added = ()) -> np.ndarray:
    """Ids of the text, then id 0."""
    return np.array([*encoder(ranks_path, added).encode(text, allowed_special="all"), 0], dtype="<u4")


def pieces(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, added: Added = ()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for every piece of ``docs(doc_id, text)``."""
    def run(batch):
        of, cols = [], {n: [] for n in ("piece", "start", "length", "ids_crc32")}
        for i, t in enumerate(texts_of(batch)):
            ids = token_ids(t, ranks_path, added)
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                of.append(i)
                for c, v in zip(cols.values(), (k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                    c.append(v)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return {"doc_id": batch.column("doc_id").take(pa.array(of, pa.int64()))} | {
            n: pa.array(v, t) for (n, v), t in zip(cols.items(), types, strict=True)}
    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[int, list[tuple[int, int]]]   # how many sequences, and their runs (length, how often)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over counts: equal sequences move as one group."""
    room: dict[int, list[Pattern]] = defaultdict(list)
    free: list[int] = []

    def put(residual: int, n: int, runs: list) -> None:
        if not room[residual]:
            bisect.insort(free, residual)
        room[residual].append((n, runs))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect.bisect_left(free, size)
            if i < len(free):
                residual = free[i]
                n, runs = room[residual].pop()
                if not room[residual]:
                    free.pop(i)
            else:
                residual, n, runs = capacity, left, []
            each = residual // size
            used = min(n, left // each)
            if used:
                put(residual - each * size, used, [*runs, (size, each)])
                left -= used * each
            elif left:
                put(residual - left * size, 1, [*runs, (size, left)])
                left, used = 0, 1
            if runs and n > used:
                put(residual, n - used, runs)
    return [p for groups in room.values() for p in groups]


def _inside(small: tuple, large: tuple) -> bool:
    """Proof that filling ``small`` is dominated: its pieces fit into the places of ``large``'s pieces."""
    places = list(large)
    for s in small:
        for i, p in enumerate(places):
            if p >= s:
                places[i] -= s
                break
        else:
            return False
    return True


def fillings(counts: dict[int, int], sizes: list[int], room: int, keep: int = FILLINGS, steps: int = STEPS) -> list[tuple]:
    """Undominated fillings of ``room`` with available pieces, least waste first (``sizes`` ascending)."""
    found: dict[tuple, int] = {}
    budget = [steps]

    def extend(chosen: tuple, left: int, top: int) -> None:
        i = bisect.bisect_right(sizes, min(left, top)) - 1
        placed = False
        while i >= 0 and budget[0] > 0:
            s = sizes[i]
            if counts[s] > chosen.count(s):
                placed = True
                budget[0] -= 1
                extend((*chosen, s), left - s, s)
                if left - s == 0:
                    break
                if len(found) > 6 * keep:
                    return
            i -= 1
        if not placed:
            found[chosen] = left

    extend((), room, room)
    best: list[tuple] = []
    for f in sorted(found, key=lambda f: (found[f], len(f), f)):
        if not any(_inside(f, b) for b in best):
            best.append(f)
            if len(best) == keep:
                break
    return best or [()]


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns covering ``counts`` (length -> pieces) with as few sequences as the search finds."""
    counts = {s: n for s, n in counts.items() if n > 0}
    total = sum(s * n for s, n in counts.items())
    best = best_fit(counts, capacity)
    least = -(-total // capacity)
    most = sum(n for n, _ in best)
    if most <= least:
        return best
    left, sizes = dict(counts), sorted(counts)
    path: list[list] = []   # [options still to try, taken pieces, multiplicity, waste so far before]
    waste, seen, descend = 0, 0, True

    def use(taken: tuple, n: int) -> None:
        for s in taken:
            left[s] -= n
            if not left[s] and n > 0:
                sizes.remove(s)
            elif n < 0 and s not in sizes[bisect.bisect_left(sizes, s):][:1]:
                bisect.insort(sizes, s)

    while seen < nodes and most > least:
        seen += 1
        if descend:
            if not sizes:
                n = sum(p[2] for p in path)
                if n < most:
                    most, best = n, [(p[2], _runs(p[1])) for p in path]
                descend = False
                continue
            if seen % 64 == 0:
                tail = best_fit({s: left[s] for s in sizes}, capacity)
                n = sum(p[2] for p in path) + sum(m for m, _ in tail)
                if n < most:
                    most, best = n, [(p[2], _runs(p[1])) for p in path] + tail
            big = sizes[-1]
            left[big] -= 1
            options = [(big, *f) for f in fillings(left, sizes, capacity - big)]
            left[big] += 1
            path.append([options[::-1], None, 0, waste])
        top = path[-1]
        if top[1]:
            use(top[1], -top[2])
            top[1], waste = None, top[3]
        if not top[0]:
            path.pop()
            if not path:
                break
            descend = False
            continue
        taken = top[0].pop()
        n = min(left[s] // taken.count(s) for s in set(taken))
        spoilt = waste + n * (capacity - sum(taken))
        if -(-(total + spoilt) // capacity) >= most:
            descend = False
            continue
        use(taken, n)
        top[1], top[2], waste, descend = taken, n, spoilt, True
    return best


def _runs(taken: tuple) -> list[tuple[int, int]]:
    return [(s, taken.count(s)) for s in sorted(set(taken), reverse=True)]


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, by number: sorted (length, first number) with sequence, repeats and offset."""
    base, used, rows = 0, defaultdict(int), []
    for n, runs in patterns:
        offset = 0
        for size, each in runs:
            rows.append((size, used[size], base, each, offset))
            used[size] += n * each
            offset += size * each
        base += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "each", "offset"), table.T, strict=True))


def pack(found: DataFrame, capacity: int = CAPACITY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``found`` (a written table of pieces) plus ``sequence_id`` and ``offset``."""
    by_length = found.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_length.collect()}   # at most ``capacity`` rows
    at = slots(bin_completion(counts, capacity))
    chunks = by_length.select("length", F.ceil(F.col("n") / chunk_rows).alias("chunks"))
    rows = found.join(F.broadcast(chunks), "length").withColumn(   # bounded by the capacity
        "chunk", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.col("chunks"))).drop("chunks")
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = rows.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_no"))
    inside = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("no", F.row_number().over(inside)).join(start, ["length", "chunk"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_no") + F.col("no") - 1).alias("no"))
    key = at["length"] << 44 | at["first"]

    def place(batches):
        for b in batches:
            length, no = b.column("length").to_numpy(zero_copy_only=False), b.column("no").to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, length << 44 | no, side="right") - 1
            turn = no - at["first"][i]
            cols = dict(zip(b.schema.names, b.columns, strict=True))
            del cols["no"]
            cols["sequence_id"] = pa.array(at["sequence"][i] + turn // at["each"][i])
            cols["offset"] = pa.array(at["offset"][i] + turn % at["each"][i] * length)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, added: Added = ()) -> DataFrame:
    return pack(cut_lineage(pieces(docs, ranks_path, capacity, added), "pieces"), capacity)

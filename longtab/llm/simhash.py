"""SimHash near duplicates by deletion-variant signatures (operator 6).

Fingerprints within ``distance`` bits are linked.  The 64 bits are cut into so few segments that,
of two linked fingerprints, one segment differs by at most one bit (distance // 2 + 1 segments; two
halves for two bits).  Each segment is indexed once per wildcard position: equal variants differ in
that one bit at most.  Rows meet on equal variants and the whole fingerprints are compared.

Equal fingerprints are one node, so copies cost nothing in the index.  A variant that many distinct
fingerprints share is not joined pair by pair: its members go through the same idea at full width, in
linear size: for two bits, two fingerprints are linked exactly if flipping at most one bit of each
can give the same value, so members meet at their 65 values and are linked to the smallest.  No
variant is dropped or capped.

Texts without words have fingerprint zero and are linked like any others; null is an empty text.
Repeated rows are copies.  Rows with a null doc_id get their group's smallest id (null if all are null).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.common import fresh, map_batches, texts_of
from longtab.llm.components import components
from longtab.session import cut_lineage

SHINGLE, DISTANCE, SEED = 3, 2, 42
LIGHT = 16       # most fingerprints of a variant that are compared pair by pair; larger ones go the linear way
CELLS = 1 << 18  # hash values that variants are sorted out by before they move
SPACE = {i: 32 for i in (9, 10, 11, 12, 13)}
LOWER = {i: i + 32 for i in range(65, 91)} | SPACE
SLICE = 100_000  # shingles whose bits are counted at once


def fingerprint(text: str, k: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the k-word shingles, repeats counted; a bit is 1 if over half the hashes have it."""
    words = [w for w in text.translate(LOWER).split(" ") if w]
    if not words:
        return 0
    line = " ".join(words).encode("utf-8", "surrogatepass")
    ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words]) if not line.isascii() else np.cumsum(
        [len(w) + 1 for w in words])
    n = max(1, len(words) - k + 1)
    start = np.r_[0, ends[:n - 1]].tolist()
    end = (ends[min(k, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for a in range(0, n, SLICE):
        h = np.fromiter((digest(line[s:e], seed) for s, e in zip(start[a:a + SLICE], end[a:a + SLICE])), dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, *more: str) -> DataFrame:
    """(doc_id, fp): the signed 64-bit form of every row's fingerprint; ``more`` long columns are carried on."""
    def run(batch):
        fp = np.array([fingerprint(t, k) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
        return {n: batch.column(n) for n in ("doc_id", *more)} | {"fp": pa.array(fp)}
    return map_batches(docs.select("doc_id", "text", *more), run, ", ".join(f"{n} long" for n in ("doc_id", *more, "fp")))


def _variants(distance: int) -> Column:
    """One-wildcard variants of every segment: struct(segment and wildcard position, masked bits)."""
    parts = distance // 2 + 1
    size = -(-64 // parts)
    masks = []
    for s in range(parts):
        inside = [b for b in range(s * size, min(64, (s + 1) * size))]
        whole = sum(1 << b for b in inside)
        masks += [(s * 64 + b, whole & ~(1 << b)) for b in inside]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*[F.struct(F.lit(p).cast("short").alias("slot"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("part"))
                     for p, m in masks])


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _flips(distance: int) -> Column:
    """Values within distance / 2 bits (distance 2: the fingerprint and its 64 one-bit neighbours)."""
    if distance != 2:
        raise ValueError("the linear form of dense variants is for distance 2")
    bits = [(1 << b) - (1 << 64 if b == 63 else 0) for b in range(64)]
    return F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(b)) for b in bits])


def links(fps: DataFrame, distance: int = DISTANCE, light: int = LIGHT) -> DataFrame:
    """Distinct ``fps(fp)`` -> edges (u, v) that join exactly the fingerprints reachable by links.

    Light variants give every verified pair; dense ones give stars (same components, linear size)."""
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    var = fps.repartition(tasks).select("fp", F.explode(_variants(distance)).alias("x")).select("fp", "x.slot", "x.part")
    by = Window.partitionBy("slot", "part")
    # numbering with a bound is cut in the tasks before the shuffle: light + 1 rows tell a variant's few members or that it is dense
    head = var.withColumn("no", F.row_number().over(by.orderBy("fp"))).where(F.col("no") <= light + 1)
    shared = cut_lineage(head.withColumn("n", F.count(F.lit(1)).over(by)).where("n > 1"), "variants")
    few = shared.where(F.col("n") <= light).select("slot", "part", "fp")
    pairs = (few.select("slot", "part", F.col("fp").alias("u")).join(few.withColumnRenamed("fp", "v"), ["slot", "part"])
             .where((F.col("u") < F.col("v")) & (_apart("u", "v") <= distance)).select("u", "v"))
    crowded = shared.where((F.col("n") > light) & (F.col("no") == 1)).select("slot", "part")
    # members of crowded variants: tasks test a hash of the variant against the crowded ones' (CELLS values at most), the few left move
    cell = F.pmod(F.xxhash64("slot", "part"), F.lit(CELLS)).cast("int")
    cells = crowded.select(cell.alias("cell")).distinct()
    near = var.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left_semi")
    dense = near.join(crowded, ["slot", "part"], "left_semi").select("fp").distinct()
    meet = dense.select("fp", F.explode(_flips(distance)).alias("at"))
    least = meet.groupBy("at").agg(F.min("fp").alias("u"), F.max("fp").alias("top")).where("u < top").select("at", "u")
    stars = meet.join(least, "at").where("u <> fp").select("u", F.col("fp").alias("v"))
    return pairs.unionByName(stars)


def _grouped(docs: DataFrame, k: int, distance: int, *more: str) -> DataFrame:
    """(doc_id, ``more``, fp, component, component_id) for every row; ``component`` is a fingerprint, one for each group,
    while groups with rows of one repeated id may have the same ``component_id``."""
    prints = cut_lineage(fingerprints(docs, k, *more), "fingerprints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    comp = components(links(nodes.select("fp"), distance))
    least = comp.groupBy("node").agg(F.min("component").alias("component"))
    named = nodes.join(least.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = named.join(ids, "component").select("fp", "component", "component_id")
    return prints.join(by_print, "fp")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``."""
    return _grouped(docs, k, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for every group, of those with the group's smallest id; columns as they were.  Groups of unlike
    texts that share an id keep a row each.  Rows without an id cannot stand for a group and stay."""
    cols = docs.columns
    keep, mark, no = fresh(docs, "keep_id", "keep_mark", "keep_no")
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))   # tells the rows of a repeated id apart
    best = (_grouped(marked, k, distance, "mark").where("doc_id = component_id").groupBy("component", "component_id")
            .agg(F.min("mark").alias(mark)).select(F.col("component_id").alias(keep), mark))
    held = docs.join(best, (F.col("doc_id") == F.col(keep)) & (F.xxhash64("text") == F.col(mark)))
    rank = Window.partitionBy(keep, mark).orderBy(F.xxhash64("text"))
    once = held.withColumn(no, F.row_number().over(rank)).where(F.col(no) == 1).select(*cols)
    return once.unionByName(docs.where("doc_id is null"))

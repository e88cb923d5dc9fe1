"""Embedding near duplicates by randomised-rotation binary codes (operator 5).

Unit vectors are turned by seeded random rotations; the signs are the code, and the inner product of a
vector with its own code is stored as the code's correction factor.  Dividing the code's inner product
with another (turned) vector by that factor estimates their inner product without bias, and the error
has a known bound; a pair is computed exactly (double precision) only if estimate + bound reaches the
threshold.

Which pairs are estimated: vectors of one label (and dimension) meet in buckets of equal code bands.
The band width grows with the logarithm of the largest label's size, so buckets stay small, and the number of
bands is set so that a pair at the threshold misses all of them with a chance below ``MISS`` (1e-9);
more similar pairs even less.  First only codes are shuffled; vectors follow for shared buckets alone.
A pair is counted in the first band it shares.  A large bucket is cut into blocks and every pair of
blocks is a task's work of fixed size; tasks give counts and one local representative per vector, never
the pairs themselves.

Equal vectors of a label are one node with a weight.  Vectors that are null, zero or hold null or
non-finite components, and those with a null label, link with nothing (0 links, a component of
their own).  Vectors of different dimension don't link.  Rows that repeat a vec_id are vectors of their own
for the counts and one node for components.  Rows with a null vec_id count as links; their component is
the smallest id there is, else null, and they are kept only if there is none.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.components import components
from longtab.session import cut_lineage

COSINE, MISS, SEED = 0.98, 1e-9, 17
SURE = 6.2            # standard errors of the estimate: a tail below 1e-9
BLOCK = 1024          # vectors of a block; a task holds two
WIDTHS = (8, 24)      # least and most bits of a band


def usable(col: str) -> Column:
    return F.col(col).isNotNull() & ~F.exists(
        col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists(col, lambda x: x != 0)


def plan_bands(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits of a band, number of bands) for the largest label's number of vectors."""
    width = min(max(WIDTHS[0], math.ceil(math.log2(max(rows, 2))) + 3), WIDTHS[1])
    agree = (1 - math.acos(cosine) / math.pi) ** width
    return width, math.ceil(math.log(miss) / math.log1p(-agree))


@lru_cache(maxsize=8)
def rotations(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """[dim, bits]: the columns of as many seeded random rotations as needed."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(-(-bits // dim)):
        q, r = np.linalg.qr(rng.normal(size=(dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out, axis=1)[:, :bits]


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)   # no overflow or underflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def band_keys(x: np.ndarray, width: int, bands: int) -> np.ndarray:
    """[rows, bands] integers of the sign bits of unit vectors."""
    sign = (x @ rotations(x.shape[1], width * bands) > 0).reshape(len(x), bands, width)
    return sign @ (1 << np.arange(width, dtype=np.int64))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(label, embedding, dim, weight, first, node): one row per distinct usable vector of a label."""
    ok = vectors.where(usable("embedding") & F.col("label").isNotNull())
    same = ok.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    return same.select("label", "embedding", F.size("embedding").alias("dim"), "weight", "first",
                       F.monotonically_increasing_id().alias("node"))


def shared_buckets(nodes: DataFrame, width: int, bands: int) -> DataFrame:
    """(node, label, dim, band, key, n): the buckets that hold at least two nodes."""
    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                for a in range(0, len(part), 2048):
                    p = part.iloc[a:a + 2048]
                    keys = band_keys(unit(matrix(p["embedding"])), width, bands)
                    yield pd.DataFrame({"node": np.repeat(p["node"].to_numpy(), bands), "label": np.repeat(p["label"].to_numpy(), bands),
                                        "dim": dim, "band": np.tile(np.arange(bands), len(p)), "key": keys.ravel()})
    keyed = nodes.select("node", "label", "dim", "embedding").mapInPandas(run, "node long, label long, dim int, band int, key long")
    bucket = Window.partitionBy("label", "dim", "band", "key")
    return keyed.withColumn("n", F.count(F.lit(1)).over(bucket)).where("n > 1")


MEET = ["label", "dim", "band", "key", "low", "high"]   # a meeting: a block with itself (low = high) or with another


def meeting_pairs(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each row of sorted whole meetings: (first partner, number of partners), partners being later rows."""
    n = len(pdf)
    keys = pdf[MEET].to_numpy()
    new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, n])
    end = np.repeat(begin + size, size)
    row = np.arange(n)
    alone = (pdf["low"] == pdf["high"]).to_numpy()
    lower = (pdf["own"] == pdf["low"]).to_numpy()
    middle = np.repeat(begin + np.add.reduceat(lower.astype(np.int64), begin), size)
    first = np.where(alone, row + 1, np.where(lower, middle, end))
    return first, end - first


def linked(pdf: pd.DataFrame, cosine: float, width: int, bands: int, most: int = 400_000) -> pd.DataFrame:
    """Links of sorted whole meetings of one dimension: (node, links, root)."""
    x = unit(matrix(pdf["embedding"]))
    dim = x.shape[1]
    turned = x @ rotations(dim, dim)
    code = np.where(turned > 0, 1.0, -1.0) / math.sqrt(dim)
    factor = np.einsum("ij,ij->i", code, turned)                          # the code's correction factor
    error = np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor * (SURE / math.sqrt(max(1, dim - 1)))
    keys, band = band_keys(x, width, bands), pdf["band"].to_numpy()
    first, count = meeting_pairs(pdf)
    found = []
    stops = np.searchsorted(np.cumsum(count), np.arange(most, count.sum() + most, most), side="left") + 1
    for lo, hi in zip(np.r_[0, stops[:-1]], stops):
        hi = min(int(hi), len(pdf))
        c = count[lo:hi]
        i = np.repeat(np.arange(lo, hi), c)
        j = np.repeat(first[lo:hi] - np.cumsum(c) + c, c) + np.arange(len(i))
        guess = np.einsum("ij,ij->i", code[i], turned[j]) / factor[i]
        near = guess + error[i] >= cosine - 1e-9
        i, j = i[near], j[near]
        fresh = np.ones(len(i), bool)                                     # not met in an earlier band
        for t in range(bands):
            fresh &= (keys[i, t] != keys[j, t]) | (t >= band[i])
        i, j = i[fresh], j[fresh]
        sure = np.einsum("ij,ij->i", x[i], x[j]) >= cosine                # exact recomputation
        found.append((i[sure], j[sure]))
    i, j = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    ids, at = np.unique(pdf["node"].to_numpy(), return_inverse=True)
    weight = pdf["weight"].to_numpy()
    i, j, wi, wj = at[i], at[j], weight[i], weight[j]
    count = np.bincount(i, wj, len(ids)) + np.bincount(j, wi, len(ids))
    root = np.arange(len(ids))
    while len(i):                                                         # smallest node reachable within this batch
        new = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        if (new == root).all():
            break
        root = new
    on = np.flatnonzero(count)
    return pd.DataFrame({"node": ids[on], "links": count[on].astype(np.int64), "root": ids[root[on]]})


def links(nodes: DataFrame, cosine: float = COSINE, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(node, links, root): parts of a node's link count and members of its component, from all block pairs."""
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width, bands = plan_bands(largest, cosine, miss)
    shared = shared_buckets(nodes, width, bands)
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = shared.withColumn("blocks", blocks).withColumn("own", own)
    # every block meets itself and each other block once: (low, high) names the meeting
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "label", "dim", "band", "key", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = met.join(nodes.select("node", "embedding", "weight"), "node")

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            keys = pdf[MEET].to_numpy()
            last = len(pdf) - 1 - int((keys[::-1] != keys[-1]).any(axis=1).argmax()) + 1 if (keys != keys[-1]).any() else 0
            whole, held = pdf.iloc[:last], pdf.iloc[last:]                 # the last meeting may go on
            for _, part in whole.groupby("dim", sort=False):
                yield linked(part.reset_index(drop=True), cosine, width, bands)
        if held is not None and len(held):
            yield linked(held.reset_index(drop=True), cosine, width, bands)
    meetings = rows.repartition(*MEET).sortWithinPartitions(*MEET, "own")
    return meetings.mapInPandas(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding, label)``."""
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    nodes = cut_lineage(nodes_of(rows), "vectors")
    found = cut_lineage(links(nodes, cosine).groupBy("node", "root").agg(F.sum("links").alias("links")), "vector-links")
    comp = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    comp = comp.groupBy("node").agg(F.min("component").alias("component"))
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (nodes.join(comp, "node", "left").join(count, "node", "left")
             .select("label", "embedding", "node", "first", F.coalesce("component", "node").alias("component"),
                     (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n")))
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    per = named.join(least, "component").select(F.col("label").alias("l"), F.col("embedding").alias("e"), "n", "least")
    joined = rows.join(per, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    component = F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))

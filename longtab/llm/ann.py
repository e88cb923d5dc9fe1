"""Approximate nearest neighbours with a robust-pruned directed graph per shard (operator 10).

Rows are dealt by hash to shards of about ``SHARD_ROWS``; a task builds one shard's graph: points enter in
growing batches, a greedy search on the graph so far proposes neighbours, and relaxed distance pruning
(a candidate goes if a kept neighbour is ``ALPHA`` times closer to it than the point is) keeps few but diverse
edges; edges are added backwards and pruned again; a second pass lets points of one batch find each
other; nodes that no walk from the entry comes to get an edge from a near node.  Equal vectors of a shard are one graph node with all its ids.

Graphs are a written table.  Queries form blocks, and every block searches every shard by beam search: a
shard's graph comes first in its partition and is loaded once, the blocks stream past it.  The beam's nodes are measured in double precision on the original vectors, each shard gives a query's
best ten, and a ranked window merges them.

Every usable row is indexed; vectors that are null, zero or hold null or non-finite components take no
part.  A query meets vectors of its own dimension only, and no row with its own vec_id.  Query rows that repeat
id and vector count once.  Null vec_ids are candidates of no query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.embed_dedup import matrix, usable
from longtab.session import cut_lineage

DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA, SEED = 32, 64, 128, 1.2, 23
SHARD_ROWS, QUERY_ROWS, NEAREST = 4096, 512, 10
SPARE = 8      # columns that the lists of edges grow by


def _dist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows a[i] to b[i, k]."""
    d = b - a[:, None, :]
    return np.einsum("ikd,ikd->ik", d, d)


def _frame(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Middle and scale of a shard, for its single-precision copy."""
    scale = max(np.abs(x).max(), 1e-300)
    middle = (x / scale).mean(axis=0)
    return middle, scale


def _small(x: np.ndarray, middle: np.ndarray, scale: float) -> np.ndarray:
    return (x / scale - middle).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, q: np.ndarray, entry: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for all queries at once: (ids, squared distances), each [queries, beam], nearest first, -1 for none."""
    n = len(q)
    ids, dist, done = np.full((n, beam), -1), np.full((n, beam), np.inf, dtype=x.dtype), np.zeros((n, beam), bool)
    ids[:, 0] = entry
    dist[:, 0] = _dist(q, np.broadcast_to(x[entry], (n, 1, x.shape[1])))[:, 0]
    rows = np.arange(n)
    while len(rows):
        todo = ~done[rows] & (ids[rows] >= 0)
        rows = rows[todo.any(axis=1)]
        if not len(rows):
            break
        at = (~done[rows] & (ids[rows] >= 0)).argmax(axis=1)
        done[rows, at] = True
        near = graph[ids[rows, at]]
        known = (near[:, :, None] == ids[rows][:, None, :]).any(axis=2) | (near < 0)
        d = _dist(q[rows], x[np.maximum(near, 0)])
        d[known] = np.inf
        both = np.concatenate([dist[rows], d], axis=1)
        best = np.argsort(both, axis=1, kind="stable")[:, :beam]
        dist[rows] = np.take_along_axis(both, best, axis=1)
        new = np.take_along_axis(np.concatenate([ids[rows], np.where(known, -1, near)], axis=1), best, axis=1)
        ids[rows] = np.where(np.isinf(dist[rows]), -1, new)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], np.zeros(near.shape, bool)], axis=1), best, axis=1)
    return ids, dist


def robust_prune(x: np.ndarray, p: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """[points, degree] neighbours out of candidates [points, c] (-1 for none)."""
    cand = np.sort(cand, axis=1)
    valid = (cand >= 0) & (cand != p[:, None])
    valid[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    y = x[np.maximum(cand, 0)]
    d = np.where(valid, _dist(x[p], y), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, axis=1), np.take_along_axis(d, order, axis=1)
    y = np.take_along_axis(y, order[:, :, None], axis=1)
    y = y - x[p][:, None, :]      # seen from the point, so that neighbours of a tight group don't drown in rounding
    norm = np.einsum("ikd,ikd->ik", y, y)
    gap = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(y, y.transpose(0, 2, 1))
    alive, rows, out = np.isfinite(d), np.arange(len(p)), np.full((len(p), degree), -1)
    for k in range(degree):
        if not alive.any():
            break
        at, has = alive.argmax(axis=1), alive.any(axis=1)
        out[has, k] = cand[rows, at][has]
        alive &= ~(alpha * alpha * gap[rows, at] <= d)
        alive[rows, at] = False
    return out


def _link_back(x: np.ndarray, graph: np.ndarray, p: np.ndarray, degree: int, alpha: float) -> None:
    """Add the edges q -> p for all p -> q, pruning lists that overflow."""
    to, source = graph[p].ravel(), np.repeat(p, degree)
    to, source = to[to >= 0], source[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    node, first, n = np.unique(to, return_index=True, return_counts=True)
    turn = np.arange(len(to)) - np.repeat(first, n)
    slot = np.repeat(np.arange(len(node)), n)
    for lap in range(-(-int(n.max(initial=0)) // degree)):       # a hub takes its new edges in several rounds
        now = (turn >= lap * degree) & (turn < (lap + 1) * degree)
        some = np.unique(slot[now])
        extra = np.full((len(some), degree), -1)
        extra[np.searchsorted(some, slot[now]), turn[now] - lap * degree] = source[now]
        for a in range(0, len(some), 512):
            at = node[some[a:a + 512]]
            graph[at] = robust_prune(x, at, np.concatenate([graph[at], extra[a:a + 512]], axis=1), degree, alpha)


def reached(graph: np.ndarray, entry: int) -> np.ndarray:
    """Which nodes a walk from the entry can come to."""
    seen = np.zeros(len(graph), bool)
    seen[entry], front = True, np.array([entry])
    while len(front):
        to = np.unique(graph[front])
        front = to[(to >= 0) & ~seen[np.maximum(to, 0)]]
        seen[front] = True
    return seen


def attach(x: np.ndarray, graph: np.ndarray, entry: int, beam: int, lot: int = 256) -> np.ndarray:
    """The graph with an edge to every node that could not be reached, from a near node that can; lists grow as they must."""
    while not (seen := reached(graph, entry)).all():
        lost = np.flatnonzero(~seen)[:lot]
        near, _ = beam_search(x, graph, x[lost], entry, beam)
        free = (graph < 0).sum(axis=1)
        if not all(any(free[v] > 0 for v in row if v >= 0) for row in near.tolist()):
            graph = np.concatenate([graph, np.full((len(graph), SPARE), -1)], axis=1)
            free = (graph < 0).sum(axis=1)
        for u, row in zip(lost.tolist(), near.tolist(), strict=True):
            v = next((v for v in row if v >= 0 and free[v] > 0), -1)
            if v >= 0:
                graph[v, int(np.argmax(graph[v] < 0))] = u
                free[v] -= 1
    return graph


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = SEED) -> tuple[np.ndarray, int]:
    """Graph [n, degree or more] (-1 for none) and entry point over distinct rows ``x``; every node can be reached."""
    n = len(x)
    graph = np.full((n, degree), -1)
    mean = x.mean(axis=0, keepdims=True)
    entry = int(_dist(mean, x[None])[0].argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = np.r_[entry, order[order != entry]]
    for second in (False, True):
        at = 0 if second else min(n, degree + 1)
        if not second:
            head = order[:at]
            graph[head] = robust_prune(x, head, np.broadcast_to(head, (at, at)), degree, alpha)
        while at < n:
            p = order[at:at + (512 if second else min(512, at))]
            found, _ = beam_search(x, graph, x[p], entry, beam)
            graph[p] = robust_prune(x, p, np.concatenate([found, graph[p]], axis=1), degree, alpha)
            _link_back(x, graph, p, degree, alpha)
            at += len(p)
    return attach(x, graph, entry, beam), entry


def shards(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: (dim, shard, nodes, entry, ids, node, vectors, graph); arrays as bytes."""
    total = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = rows.join(total, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), "shards").cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, node = np.unique(matrix(pdf["embedding"]), axis=0, return_inverse=True)
        graph, entry = build(_small(x, *_frame(x)))
        ids, node = pdf["vec_id"].to_numpy(dtype=np.int64), node.ravel()
        order = np.lexsort((ids, node))
        first = np.searchsorted(node[order], np.arange(len(x) + 1))
        return pd.DataFrame([{"dim": pdf["dim"].iloc[0], "shard": pdf["shard"].iloc[0], "nodes": len(x), "entry": entry,
                              "ids": ids[order].tobytes(), "first": first.astype(np.int64).tobytes(), "vectors": x.tobytes(),
                              "graph": graph.astype(np.int32).tobytes()}])
    # a shard is much work for few bytes: partitions by number, which are not merged by size
    tasks = 4 * max(1, total.agg(F.sum("shards")).first()[0] or 0)
    return dealt.select("vec_id", "embedding", "dim", "shard").repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(
        run, "dim int, shard int, nodes int, entry int, ids binary, first binary, vectors binary, graph binary")


def query_blocks(queries: DataFrame, query_rows: int = QUERY_ROWS) -> DataFrame:
    """One row per block of queries: (dim, block, ids, vectors)."""
    blocks = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("blocks"))
    dealt = queries.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), "blocks").cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"dim": pdf["dim"].iloc[0], "block": pdf["block"].iloc[0],
                              "query_ids": pdf["vec_id"].to_numpy(dtype=np.int64).tobytes(), "query_vectors": matrix(pdf["embedding"]).tobytes()}])
    return dealt.select("vec_id", "embedding", "dim", "block").groupBy("dim", "block").applyInPandas(
        run, "dim int, block int, query_ids binary, query_vectors binary")


class Shard:
    """A shard's graph, loaded once for all blocks of queries."""

    def __init__(self, r) -> None:
        self.key, self.entry = (r.dim, r.shard), int(r.entry)
        self.x = np.frombuffer(r.vectors).reshape(-1, r.dim)
        self.graph = np.frombuffer(r.graph, dtype=np.int32).reshape(len(self.x), -1)
        self.ids, self.first = np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.first, dtype=np.int64)
        self.frame = _frame(self.x)
        self.small = _small(self.x, *self.frame)

    def search(self, r, nearest: int, beam: int) -> pd.DataFrame:
        """A block of queries: (query_id, query_no, vec_id, score), at most ``nearest`` a query."""
        qid, q = np.frombuffer(r.query_ids, dtype=np.int64), np.frombuffer(r.query_vectors).reshape(-1, r.dim)
        found, _ = beam_search(self.small, self.graph, _small(q, *self.frame), self.entry, beam)
        return exact(self.x, self.ids, self.first, found, qid, q, int(r.block), nearest)


def exact(x: np.ndarray, ids: np.ndarray, first: np.ndarray, found: np.ndarray, qid: np.ndarray, q: np.ndarray, block: int, nearest: int) -> pd.DataFrame:
    """The beam's nodes measured in double precision on the original vectors."""
    # each node stands for its smallest ids: one more than asked, as the query's own row may be among them
    take = np.arange(nearest + 1)
    at = first[np.maximum(found, 0)][:, :, None] + take
    ok = (found >= 0)[:, :, None] & (at < first[np.maximum(found, 0) + 1][:, :, None])
    cand = ids[np.minimum(at, len(ids) - 1)]
    ok &= cand != qid[:, None, None]
    with np.errstate(over="ignore"):
        score = np.sqrt(_dist(q, x[np.maximum(found, 0)]))[:, :, None]
    score = np.where(ok, score, np.inf).reshape(len(q), -1)
    cand = np.where(ok, cand, np.iinfo(np.int64).max).reshape(len(q), -1)
    best = np.lexsort((cand, score), axis=1)[:, :nearest]
    score, cand = np.take_along_axis(score, best, axis=1), np.take_along_axis(cand, best, axis=1)
    keep = cand < np.iinfo(np.int64).max
    i = np.nonzero(keep)[0]
    return pd.DataFrame({"query_id": qid[i], "query_no": i + block * (1 << 32), "vec_id": cand[keep], "score": score[keep]})


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, beam: int = QUERY_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors(vec_id, embedding)`` that ``is_query`` picks."""
    rows = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select("vec_id", "embedding", F.size("embedding").alias("dim"))
    index = cut_lineage(shards(rows), "graphs")
    blocks = cut_lineage(query_blocks(rows.where(is_query).dropDuplicates(["vec_id", "embedding"])), "queries")
    count = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    asked = blocks.join(count, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    both = index.withColumn("block", F.lit(-1)).unionByName(asked, allowMissingColumns=True)
    tasks = 4 * max(1, index.count())
    meet = both.repartition(tasks, "dim", "shard").sortWithinPartitions("dim", "shard", "block")

    def run(batches):
        shard = None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.block < 0:
                    shard = Shard(r)
                elif shard is not None and shard.key == (r.dim, r.shard):
                    yield shard.search(r, k, beam)
    found = meet.mapInPandas(run, "query_id long, query_no long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_no").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

"""Genome sketches, similarity and greedy dereplication (SEQ4, SEQ5) — our definitions.

Sketch: the ``s`` smallest distinct hashes of a genome's canonical k-mers (k-mer or its reverse
complement, whichever is smaller).  ``hash='md5'`` uses the first 60 bits of md5 (same value in
DuckDB, for the oracle); ``hash='xxhash64'`` is the fast native choice.

ANI estimate between two sketches A, B: j = |bottom_s(A u B) n A n B| / |bottom_s(A u B)|;
ANI = 1 + ln(2j / (1 + j)) / k (Mash distance), null when j = 0.

Dereplication (sequential definition): genomes in rank order (score desc, id); a genome is a
representative iff no earlier representative is within the ANI threshold; every other genome
joins its *closest* representative (highest ANI, ties to the better-ranked one).

Distributed form, over each genome's *prefix* hashes only: its sketch in a common order (rarest hash
first, by its count among some 10,000 genomes, then hash), the first ``n - ceil(j_min * n) + 1`` of n.  Two genomes with
j >= j_min share at least ``ceil(j_min * n)`` hashes, so they must share a prefix hash: exact, no cap,
no dropped hashes and no pair enumeration inside crowded hash groups.

* each round, every prefix hash gets a *leader* = the best-ranked undecided genome holding it
  (a ``min_by`` aggregate, map-side combined, so a hash held by a third of all genomes is cheap);
* a genome that leads all its prefix hashes, or all but so few that no better undecided genome could be similar, is
  a representative;
* undecided genomes are compared with the new representatives they share enough prefix hashes with; those
  within the threshold are members.
Prefixes are ``SHARED - 1`` hashes longer than that, so two similar genomes have ``SHARED`` of them in common (or all their
common hashes, if fewer); pairs that share fewer are never compared.
After the first round (which takes in the crowds of copies), and as soon as few enough genomes share each hash, all
undecided pairs that share so many are compared once, and the rounds go on over the similar ones alone: a genome without a
better undecided similar one is a representative, those similar to it are members.
At least the best undecided genome settles each round; a round without progress is an error.  The state
is written every round as a table in ``spark.checkpoint.dir`` (lineage cut).  At the end the members of the leader rounds
meet the representatives of later rounds; no pair is compared twice.  Members join the closest.

Sketches are kept and moved as codes (``functions/kmerhash.py``): s hashes are 8 s bytes that nothing compresses, the
letters they come from often a tenth of it.  Tasks decode what they compare.  Written steps free their shuffle files.

The sketch estimates j with a standard error of about sqrt(j (1 - j) / s): 0.012 at ANI 0.995 (j = 0.82) with
the default s = 1000, which is 0.0004 in ANI (the error of j over k j (1 + j)).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import kmerhash as KH
from ..session import cut_lineage, ensure_checkpoint_dir
from . import reads as RD

SKETCH_K = 21
SKETCH_SIZE = 1000
ANI_THRESHOLD = 0.995
ORDER_GENOMES = 10_000       # genomes that the order of the prefix hashes is taken from
PAIRS = 2                    # pairs of holders for each prefix hash row of the start, up to which all of them meet at once
ORDER_HASHES = 500_000       # hashes that it places behind the others
SHARED = 16                  # prefix hashes that similar genomes have in common (prefixes are so much longer)
CODES = 500                  # codes decoded at once

_written = partial(cut_lineage, free=True)


def _lowest(hashes: Column, s: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, s)


def _pieces(genomes: DataFrame, k: int, genome_col: str) -> DataFrame:
    """``(genome_id, _b)``: the sequences as bytes, in overlapping chunks of ``KMER_CHUNK`` k-mers."""
    b = F.col("_s")
    cut = F.transform(F.sequence(F.lit(0), F.length(b) - k, F.lit(RD.KMER_CHUNK)),
                      lambda i: F.substring(b, i + 1, F.lit(RD.KMER_CHUNK + k - 1)))
    # short ones go by a null array: a filter would make the sequences twice
    return (genomes.select(genome_col, F.encode(F.col("seq"), "US-ASCII").alias("_s"))
                   .select(genome_col, F.explode(F.when(F.length(b) >= k, cut)).alias("_b")))


def _xxhash_sketches(genomes: DataFrame, k: int, s: int, genome_col: str) -> DataFrame:
    """``(genome_id, low)`` by xxhash64, inside the row: both strands are cut alike, into chunks and small pieces."""
    def cut(b: Column, r: Column, size: int) -> Column:
        n, m = F.length(b), size + k - 1
        return F.transform(F.sequence(F.lit(0), n - k, F.lit(size)), lambda i: F.struct(
            F.substring(b, i + 1, F.lit(m)).alias("b"),
            F.substring(r, F.greatest(n - i - m, F.lit(0)) + 1, F.least(n - i, F.lit(m))).alias("r")))

    def kmer_hashes(p: Column) -> Column:
        b, r = p["b"], p["r"]
        canon = lambda i: F.least(F.substring(b, i + 1, F.lit(k)), F.substring(r, F.length(b) - i - k + 1, F.lit(k)))
        return F.transform(F.sequence(F.lit(0), F.length(b) - k), lambda i: F.xxhash64(canon(i)))

    g = genomes.filter(F.length("seq") >= k).select(genome_col, F.encode(F.col("seq"), "US-ASCII").alias("_b"), F.encode(
        F.reverse(F.translate("seq", "ACGT", "TGCA")), "US-ASCII").alias("_r"))
    c = g.select(genome_col, F.explode(cut(F.col("_b"), F.col("_r"), RD.KMER_CHUNK)).alias("_c"))
    c = c.select(genome_col, cut(F.col("_c.b"), F.col("_c.r"), RD.KMER_PIECE).alias("_p"))
    return c.select(genome_col, _lowest(F.flatten(F.transform("_p", kmer_hashes)), s).alias("low"))


def _schema(df: DataFrame, genome_col: str, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(genome_col, df.schema[genome_col].dataType), *[T.StructField(n, t) for n, t in fields]])


def _batch(*cols: tuple[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for _, c in cols], names=[n for n, _ in cols])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, CODES):
        yield batch.slice(at, CODES)


def _merged(rows: Iterator[tuple[object, bytes, int]], s: int) -> Iterator[tuple[object, bytes, int]]:
    """One (genome, code, n) for the rows of a genome that stand together, whatever their number."""
    def one(codes: list[tuple[bytes, int]]) -> tuple[bytes, int]:
        if len(codes) == 1:
            return codes[0]
        low = KH.lowest(np.concatenate(KH.decoded([c for c, _ in codes])), s)
        return KH.code_of_hashes(low), len(low)

    genome, codes = None, []
    for g, code, n in rows:
        if codes and g != genome:
            yield genome, *one(codes)
            codes = []
        genome = g
        codes.append((code, n))
        if len(codes) == 64:
            codes = [one(codes)]
    if codes:
        yield genome, *one(codes)


def _grouped(rows: Iterator[tuple], kind: pa.DataType, genome_col: str) -> Iterator[pa.RecordBatch]:
    """Rows (genome, code, n) as batches of some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size > 4 * KH.CHARS or len(held) >= 10_000:
            yield _batch((genome_col, pa.array([r[0] for r in held], kind)), ("code", pa.array([r[1] for r in held], pa.binary())),
                         ("n", pa.array([r[2] for r in held], pa.int32())))
            held, size = [], 0
    if held:
        yield _batch((genome_col, pa.array([r[0] for r in held], kind)), ("code", pa.array([r[1] for r in held], pa.binary())),
                     ("n", pa.array([r[2] for r in held], pa.int32())))


def _with_kind(batches: Iterator[pa.RecordBatch], make, genome_col: str) -> Iterator[pa.RecordBatch]:
    """``make`` turns the batches into rows (genome, code, n); the genome's type is that of the first batch."""
    first = next(batches, None)
    if first is None:
        return

    def all_():
        yield first
        yield from batches
    yield from _grouped(make(all_()), first.column(0).type, genome_col)


def _coded_rows(df: DataFrame, make, genome_col: str) -> DataFrame:
    """``(genome_id, code, n)`` of the rows that ``make`` gives for batches of ``df`` (whose first column is the genome)."""
    return df.mapInArrow(lambda batches: _with_kind(batches, make, genome_col),
                         _schema(df, genome_col, ("code", T.BinaryType()), ("n", T.IntegerType())))


def _piece_codes(genomes: DataFrame, k: int, s: int, how: str, genome_col: str) -> DataFrame:
    """``(genome_id, code, n)``: the sketch of every piece that a row is cut into; those of a row that stand together are one."""
    if how not in ("md5", "xxhash64"):
        raise ValueError(how)
    if how == "xxhash64":
        return _coded(_xxhash_sketches(genomes, k, s, genome_col).withColumnRenamed("low", "hs"), genome_col)

    def coded(batches):
        for batch in batches:
            genomes_, seqs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield from ((g, *c) for g, c in zip(genomes_, KH.codes_of_sequences(seqs, k, s)))
    return _coded_rows(_pieces(genomes, k, genome_col), lambda batches: _merged(coded(batches), s), genome_col)


def _decoded(sk: DataFrame, genome_col: str, name: str = "hs") -> DataFrame:
    """``(genome_id, hs)`` of codes."""
    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                h = KH.decoded(part.column(1).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in h])]).astype(np.int32)
                yield _batch((genome_col, part.column(0)), (name, pa.ListArray.from_arrays(ends, np.concatenate(h))))
    return sk.select(genome_col, "code").mapInArrow(run, _schema(sk, genome_col, (name, T.ArrayType(T.LongType()))))


def _piece_sketches(genomes: DataFrame, k: int, s: int, how: str, genome_col: str) -> DataFrame:
    """``(genome_id, low)``: the s smallest hashes of every row's pieces, smallest first."""
    return _decoded(_piece_codes(genomes, k, s, how, genome_col), genome_col, "low")


def coded_sketches(genomes: DataFrame, k: int = SKETCH_K, s: int = SKETCH_SIZE, hash: str = "md5",
                   genome_col: str = "genome_id") -> DataFrame:
    """``(genome_id, code, n)``: the s smallest distinct canonical k-mer hashes per genome as a code, one row each.

    Codes of pieces move once, to meet those of their genome; pieces of one genome are merged as they come, so a task
    holds s hashes of it."""
    pieces = _piece_codes(genomes, k, s, hash, genome_col).repartition(genome_col).sortWithinPartitions(genome_col)

    def rows(batches):
        for b in batches:
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
    return _coded_rows(pieces, lambda batches: _merged(rows(batches), s), genome_col)


def packed_sketches(genomes: DataFrame, k: int = SKETCH_K, s: int = SKETCH_SIZE, hash: str = "md5",
                    genome_col: str = "genome_id") -> DataFrame:
    """``(genome_id, hs)``: the hashes of ``coded_sketches``, ascending, one row each."""
    return _decoded(coded_sketches(genomes, k, s, hash, genome_col), genome_col)


def sketches(genomes: DataFrame, k: int = SKETCH_K, s: int = SKETCH_SIZE, hash: str = "md5",
             genome_col: str = "genome_id") -> DataFrame:
    """``(genome_id, h)``: a row for every hash of ``packed_sketches``."""
    return packed_sketches(genomes, k, s, hash, genome_col).select(genome_col, F.explode("hs").alias("h"))


def _coded(sk: DataFrame, genome_col: str) -> DataFrame:
    """Sketches as given by any of these: one row ``(genome_id, code, n)`` each."""
    if "code" in sk.columns:
        return sk
    if "hs" not in sk.columns:
        sk = sk.groupBy(genome_col).agg(F.sort_array(F.collect_set("h")).alias("hs"))

    def rows(batches):
        for b in batches:
            for g, h in zip(b.column(0).to_pylist(), b.column(1)):
                yield g, KH.code_of_hashes(h.values.to_numpy()), len(h.values)
    return _coded_rows(sk.select(genome_col, "hs"), rows, genome_col)


def ani_from_j(j: Column, k: int) -> Column:
    return F.when(j > 0, 1 + F.log(2 * j / (1 + j)) / k)


def edge_ani(edges: DataFrame, sk: DataFrame, k: int = SKETCH_K, s: int = SKETCH_SIZE,
             genome_col: str = "genome_id") -> DataFrame:
    """Union-sketch recount for given edges ``(a, b)``: adds ``j`` and ``ani``.  Two codes meet in
    one row per edge and are compared there."""
    edges, sk = edges.select("a", "b").distinct(), _coded(sk, genome_col)
    a = edges.join(sk.select(F.col(genome_col).alias("a"), F.col("code").alias("_ca")), "a")
    both = a.join(sk.select(F.col(genome_col).alias("b"), F.col("code").alias("_cb")), "b").select("a", "b", "_ca", "_cb")

    def compared(batches):
        for batch in batches:
            for part in _parts(batch):
                a, b = part.column(2).to_pylist(), part.column(3).to_pylist()
                codes = list({*a, *b})
                of = dict(zip(codes, KH.decoded(codes)))
                yield _batch(("a", part.column(0)), ("b", part.column(1)),
                             ("j", pa.array([KH.jaccard(of[x], of[y], s) for x, y in zip(a, b)], pa.float64())))
    kind = sk.schema[genome_col].dataType
    j = both.mapInArrow(compared, T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("j", T.DoubleType())]))
    return j.withColumn("ani", ani_from_j(F.col("j"), k))


def _leaders(sk: DataFrame, rank: DataFrame, genome_col: str) -> DataFrame:
    r = sk.join(rank, genome_col)
    return r.groupBy("h").agg(F.min_by(genome_col, F.struct("_score_neg", genome_col)).alias("_leader"))


def ranking(scores: DataFrame, genome_col: str = "genome_id", score_col: str = "score") -> DataFrame:
    return scores.select(genome_col, (-F.col(score_col)).alias("_score_neg"))


def leader_edges(sk: DataFrame, scores: DataFrame, k: int = SKETCH_K, s: int = SKETCH_SIZE,
                 genome_col: str = "genome_id", score_col: str = "score") -> DataFrame:
    """SEQ4 candidate pairs of the first round: each genome with the leaders (best-ranked genome)
    of its sketch hashes, with the union-sketch j and ANI."""
    sk = _written(_coded(sk, genome_col), "sketch")
    rows = _decoded(sk, genome_col).select(genome_col, F.explode("hs").alias("h"))
    lead = _leaders(rows, ranking(scores, genome_col, score_col), genome_col)
    e = (rows.join(lead, "h").filter(F.col("_leader") != F.col(genome_col))
             .select(F.col(genome_col).alias("a"), F.col("_leader").alias("b")).distinct())
    return edge_ani(_written(e, "edges"), sk, k, s, genome_col)


def _need(n: Column, threshold: float, k: int, shared: int) -> Column:
    """Prefix hashes that a genome with n hashes shares with any similar one: ``shared``, or all that they have in common if fewer."""
    return F.greatest(F.lit(1), F.least(F.lit(shared), F.ceil(F.lit(_j_min(threshold, k)) * n).cast("int")))


def _j_min(threshold: float, k: int) -> float:
    return max(0.0, ani_to_j(threshold, k) - 1e-9)           # never lose a float tie


def prefixes(sk: DataFrame, threshold: float, k: int = SKETCH_K, genome_col: str = "genome_id", shared: int = 1) -> DataFrame:
    """``(genome_id, h)``: the prefix hashes of every sketch; any two genomes at or above ``threshold`` share ``shared``
    of them (``_need``).

    Any order that all genomes have in common serves.  Hashes that many hold come last: their counts are taken from
    about ``ORDER_GENOMES`` genomes (all, if fewer), the ``ORDER_HASHES`` most frequent ones of them, which go to the tasks."""
    j_min, sk = _j_min(threshold, k), _coded(sk, genome_col)
    some = sk.filter(F.pmod(F.xxhash64(genome_col), F.lit(max(1, sk.count() // ORDER_GENOMES))) == 0)

    def hashes_of(batches):
        for batch in batches:
            for part in _parts(batch):
                yield _batch(("h", np.concatenate(KH.decoded(part.column(0).to_pylist()))))
    count = (some.select("code").mapInArrow(hashes_of, "h bigint").groupBy("h").agg(F.count("*").alias("c")).filter("c > 1")
                 .orderBy(F.col("c").desc(), "h").limit(ORDER_HASHES).toArrow())
    by_hash = np.argsort(h := count.column("h").to_numpy(), kind="stable")
    order = sk.sparkSession.sparkContext.broadcast((h[by_hash], count.column("c").to_numpy()[by_hash]))

    def kept(batches):
        frequent, counts = order.value
        for batch in batches:
            for part in _parts(batch):
                found = KH.decoded(part.column(1).to_pylist())
                h, sizes = np.concatenate(found), np.array([len(x) for x in found])
                c = np.zeros(len(h), np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                    c = np.where(frequent[at] == h, counts[at], 0)
                take, start = [], 0
                for n in sizes.tolist():                     # hashes are ascending: ties of the count stay in their order
                    take.append(np.argsort(c[start:start + n], kind="stable")[:n - math.ceil(j_min * n) + shared] + start)
                    start += n
                rows = np.repeat(np.arange(len(sizes)), [len(x) for x in take])
                yield _batch((genome_col, part.column(0).take(pa.array(rows))), ("h", h[np.concatenate(take)]))
    return sk.select(genome_col, "code").mapInArrow(kept, _schema(sk, genome_col, ("h", T.LongType())))


def _leader_round(own: DataFrame, alone: DataFrame, rnd: int, most: int, sk: DataFrame, threshold: float, k: int, s: int,
                  genome_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New representatives (in round 1 ``alone`` too), members of them, and the pairs ``(a, b, j, ani)`` of both.

    All prefix hashes that a genome shares with a better one have another leader, so it has no better similar one if fewer of
    its hashes than it needs do.  Where these would meet the others in more than ``most`` pairs, only those that
    lead all their hashes are taken, of which a hash has one."""
    lead = own.groupBy("h").agg(F.min_by(genome_col, F.struct("_score_neg", genome_col)).alias("_leader"))
    others = F.sum((F.col("_leader") != F.col(genome_col)).cast("int"))
    led = own.join(lead, "h").groupBy(genome_col).agg(others.alias("_others"), F.max("need").alias("_need"))
    led = _written(led.select(genome_col, (F.col("_others") < F.col("_need")).alias("_new"), (F.col("_others") == 0).alias("_all")), f"led{rnd}")
    marked = _written(own.join(led, genome_col), f"marked{rnd}")
    holders = marked.groupBy("h").agg(F.count("*").alias("_c"), F.sum(F.col("_new").cast("int")).alias("_n"))
    pairs = holders.agg(F.sum(F.col("_n") * (F.col("_c") - F.col("_n")))).first()[0]
    taken = F.col("_new") if pairs is None or pairs <= most else F.col("_all")
    new = led.filter(taken).select(genome_col)
    new = _written(new.unionByName(alone) if rnd == 1 else new, f"reps{rnd}")
    e = _near(marked.filter(~taken).select("h", F.col(genome_col).alias("a"), "need"), marked.filter(taken).select("h", F.col(genome_col).alias("b")))
    close = _written(edge_ani(_written(e, f"edges{rnd}"), sk, k, s, genome_col).filter(F.col("ani") >= threshold), f"close{rnd}")
    return new, _written(close.select(F.col("a").alias(genome_col)).distinct(), f"members{rnd}"), close


def _near(a: DataFrame, b: DataFrame, *also: Column) -> DataFrame:
    """``(a, b)`` that share the prefix hashes they need: rows (a, h, need, ...) with rows (b, h, ...)."""
    e = a.join(b, "h")
    for c in also:
        e = e.filter(c)
    return e.groupBy("a", "b").agg(F.count("*").alias("_c"), F.max("need").alias("_need")).filter("_c >= _need").select("a", "b")


def _links(own: DataFrame, most: int, sk: DataFrame, threshold: float, k: int, s: int, genome_col: str) -> DataFrame | None:
    """``(a, b, j, ani)``: every undecided genome with the better ones within the threshold; None while prefix hashes have too many
    holders to meet in pairs (more than ``most``)."""
    pairs = own.groupBy("h").agg(F.count("*").alias("_c")).agg(F.sum(F.col("_c") * (F.col("_c") - 1) / 2)).first()[0]
    if pairs is not None and pairs > most:
        return None
    key = F.struct("_score_neg", genome_col)
    a = own.select("h", F.col(genome_col).alias("a"), "need", key.alias("_ka"))
    b = own.select("h", F.col(genome_col).alias("b"), key.alias("_kb"))
    e = _written(_near(a, b, F.col("a") != F.col("b"), F.col("_kb") < F.col("_ka")), "near")
    return _written(edge_ani(e, sk, k, s, genome_col).filter(F.col("ani") >= threshold), "links")


def _settled(sk: DataFrame, scores: DataFrame, threshold: float, k: int, s: int, genome_col: str,
             score_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Representatives and members, each ``(genome_id, round)``, and every pair ``(a, b, j, ani)`` of a member and a
    representative at or above ``threshold`` with the representative's ``_score_neg``."""
    ensure_checkpoint_dir(sk.sparkSession)
    sk = _written(_coded(sk, genome_col), "sketch")
    sizes = sk.select(genome_col, _need(F.col("n"), threshold, k, SHARED).alias("need")).distinct()
    rank = _written(ranking(scores, genome_col, score_col).join(sizes, genome_col), "rank")
    one = rank.groupBy(genome_col).agg(F.min(F.struct("_score_neg"))["_score_neg"].alias("_score_neg"), F.max("need").alias("need"))
    # a hash that one genome alone holds meets nobody, and a genome with fewer others than it needs is like nobody: a representative of round 1
    held = prefixes(sk, threshold, k, genome_col, SHARED).withColumn("_c", F.count("*").over(Window.partitionBy("h"))).filter("_c > 1")
    pre = held.drop("_c").join(one, genome_col).withColumn("_c", F.count("*").over(Window.partitionBy(genome_col)))
    pre = own = _written(pre.filter("_c >= need").drop("_c"), "prefix")
    most, left = PAIRS * pre.count(), rank.select(genome_col).distinct()
    alone = left.join(pre.select(genome_col), genome_col, "left_anti")
    n, rnd, reps, members, close, links, live = left.count(), 0, [], [], [], None, None
    while n:
        rnd += 1
        if rnd > 1 and links is None:
            own = _written(own.join(left, genome_col, "left_semi"), f"own{rnd}")
            links = live = _links(own, most, sk, threshold, k, s, genome_col)
        if links is not None:
            live = live.join(left.select(F.col(genome_col).alias("a")), "a").join(left.select(F.col(genome_col).alias("b")), "b")
            live = _written(live.select("a", "b"), f"links{rnd}")
            new = left.join(live.select(F.col("a").alias(genome_col)), genome_col, "left_anti")
            new = _written(new, f"reps{rnd}")
            joined = live.join(new.select(F.col(genome_col).alias("b")), "b", "left_semi").select(F.col("a").alias(genome_col)).distinct()
            joined = _written(joined, f"members{rnd}")
        else:
            new, joined, pairs = _leader_round(own, alone, rnd, most, sk, threshold, k, s, genome_col)
            close.append(pairs)
        left = _written(left.join(new, genome_col, "left_anti").join(joined, genome_col, "left_anti"), f"left{rnd}")
        reps.append(new.withColumn("round", F.lit(rnd)))
        members.append(joined.withColumn("round", F.lit(rnd)))
        before, n = n, left.count()
        if n >= before:
            raise RuntimeError(f"round {rnd} settled no genome")
    if not rnd:
        reps, members = [left.withColumn("round", F.lit(0))], [left.withColumn("round", F.lit(0))]
    rep, mem = reps[0], members[0]
    for r, m in zip(reps[1:], members[1:]):
        rep, mem = rep.unionByName(r), mem.unionByName(m)
    sim = _pairs(pre, rep, mem, close, links, sk, threshold, k, s, genome_col)
    return rep, mem, sim.join(rank.select(F.col(genome_col).alias("b"), "_score_neg"), "b")


def _pairs(pre: DataFrame, rep: DataFrame, mem: DataFrame, close: list[DataFrame], links: DataFrame | None, sk: DataFrame,
           threshold: float, k: int, s: int, genome_col: str) -> DataFrame:
    """``(a, b, j, ani)`` of members and representatives at or above the threshold.

    A leader round compared its representatives with all that were undecided, the links all that were undecided after those
    rounds.  What is left to compare are members of a leader round with representatives of later ones."""
    # the parts are tables: Spark may take a union for dealt out as its parts are, and deal out the parts otherwise when it runs
    name = lambda df, as_: df.select(F.col(genome_col).alias(as_))
    found = list(close)
    if links is not None:
        for x, y in (("a", "b"), ("b", "a")):
            of = links.select(F.col(x).alias("a"), F.col(y).alias("b"), "j", "ani")
            found.append(_written(of.join(name(mem, "a"), "a", "left_semi").join(name(rep, "b"), "b", "left_semi"), "linked"))
    early = mem.filter(F.col("round") <= len(close)).withColumnRenamed("round", "_ra")
    a = pre.join(early, genome_col).select("h", F.col(genome_col).alias("a"), "need", "_ra")
    b = pre.join(rep.withColumnRenamed("round", "_rb"), genome_col).select("h", F.col(genome_col).alias("b"), "_rb")
    late = _written(_near(a, b, F.col("_rb") > F.col("_ra")), "candidates")
    found.append(_written(edge_ani(late, sk, k, s, genome_col).filter(F.col("ani") >= threshold), "late"))
    sim = found[0].select("a", "b", "j", "ani")
    for f in found[1:]:
        sim = sim.unionByName(f.select("a", "b", "j", "ani"))
    return sim


def _closest(sim: DataFrame) -> DataFrame:
    return sim.groupBy("a").agg(F.min_by(F.struct("b", "ani"), F.struct((-F.col("ani")).alias("x"), "_score_neg", "b")).alias("_n"))


def dereplicate(sk: DataFrame, scores: DataFrame, threshold: float = ANI_THRESHOLD, k: int = SKETCH_K,
                s: int = SKETCH_SIZE, genome_col: str = "genome_id", score_col: str = "score") -> DataFrame:
    """SEQ5: ``(genome_id, rep_id, is_rep, ani, round)`` for every sketched genome that has a score."""
    rep, mem, sim = _settled(sk, scores, threshold, k, s, genome_col, score_col)
    best = _closest(sim)
    out = mem.join(best, mem[genome_col] == best["a"]).select(
        genome_col, F.col("_n.b").alias("rep_id"), F.lit(False).alias("is_rep"), F.col("_n.ani").alias("ani"), "round")
    return out.unionByName(rep.select(genome_col, F.col(genome_col).alias("rep_id"), F.lit(True).alias("is_rep"),
                                      F.lit(None).cast("double").alias("ani"), "round"))


def representative_pairs(sk: DataFrame, scores: DataFrame, threshold: float = ANI_THRESHOLD, k: int = SKETCH_K,
                         s: int = SKETCH_SIZE, genome_col: str = "genome_id", score_col: str = "score") -> DataFrame:
    """SEQ4: ``(a, b, j, ani, is_member)``: every genome ``a`` with every representative ``b`` (of the
    de-replication) at or above ``threshold``; ``is_member`` marks the one it joins."""
    sim = _written(_settled(sk, scores, threshold, k, s, genome_col, score_col)[2], "pairs")
    best = _closest(sim).select("a", F.col("_n.b").alias("_rep"))
    return sim.join(best, "a").select("a", "b", "j", "ani", (F.col("b") == F.col("_rep")).alias("is_member"))


def ani_to_j(ani: float, k: int = SKETCH_K) -> float:
    """Inverse of the Mash estimate (for choosing thresholds)."""
    d = 1.0 - ani
    e = math.exp(-d * k)
    return e / (2 - e)

"""Read-level jobs (REL2, REL3, SEQ1, SEQ2, SEQ3, SEQ6, SRC15).

Reads: ``(sample_id, read_id, seq, qual)``.  Hits: alignment rows of reads against the
spike-in plasmids or the host genome.

The adapter and duplicate jobs are our own table definitions of what the single-machine
tools do (see README); the parameters are keywords with our defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import names as NM
from . import alignments as A

# Fixed values (our definitions).
ADAPTER_WINDOW = 60          # bases searched at each read end beyond the adapter length
ADAPTER_MISMATCHES = 2       # Hamming mismatches allowed in an adapter hit
PEEK_MIN_SHARE = 0.01        # adapters seen in at least this share of peeked reads are kept
SEED = 12                    # longest seed of an adapter piece
SEED_ROWS = 50_000           # seeds that every task may hold (rows of an adapter's text and some numbers)
KMER = 21
KMER_CHUNK = 1 << 16         # k-mers of a piece of a long sequence; pieces overlap
KMER_PIECE = 256             # k-mers of the small pieces that they are cut from


# --- spike-in and host removal -------------------------------------------------------------------
def reads_without_hits(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """REL2: reads with no mapped hit (``-F 4``); ids are de-duplicated by the anti join."""
    mapped = A.flag_filter(hits, mapped=True, primary=False, no_supplementary=False)
    return reads.join(mapped.select("sample_id", "read_id"), ["sample_id", "read_id"], "left_anti")


def reads_without_host(reads: DataFrame, hits: DataFrame, min_identity: float = 99.9,
                       min_aligned: float = 95) -> DataFrame:
    """REL3: drop reads with a non-supplementary host hit passing identity/aligned minimums."""
    good = A.min_filter(A.flag_filter(hits, mapped=True, primary=False, no_supplementary=True),
                        min_identity, min_aligned)
    return reads.join(good.select("sample_id", "read_id"), ["sample_id", "read_id"], "left_anti")


# --- duplicates ----------------------------------------------------------------------------------
def mean_quality(qual) -> Column:
    """Mean Phred (+33) quality of a quality string."""
    q = F.col(qual) if isinstance(qual, str) else qual
    # how often a symbol occurs is what its removal takes off the length; no array of one-character strings is made
    total = F.aggregate(F.sequence(F.lit(33), F.lit(126)), F.lit(0).cast("bigint"),
                        lambda acc, c: acc + (c - 33) * (F.length(q) - F.length(F.replace(q, F.char(c), F.lit("")))))
    return F.when(F.length(q) > 0, total / F.length(q)).otherwise(F.lit(0.0))


def dedup_key(seq) -> Column:
    """Strand-independent key: md5 of the smaller of the sequence and its reverse complement."""
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.md5(F.least(s, NM.revcomp(s)))


def dedup_reads(reads: DataFrame) -> DataFrame:
    """SEQ3: one read per (sample, sequence up to reverse complement): best mean quality, then
    the smaller read id.  A ``min_by`` aggregate (map-side combined), so a huge duplicate group
    never sits in one task; ``dup_count`` tells how many reads the survivor stands for."""
    r = reads.withColumn("_k", dedup_key("seq")).withColumn("_mq", mean_quality("qual"))
    best = r.groupBy("sample_id", "_k").agg(
        F.min_by(F.struct("read_id", "seq", "qual", "_mq"),
                 F.struct((-F.col("_mq")).alias("q"), F.col("read_id"))).alias("_b"),
        F.count("*").alias("dup_count"))
    return best.select("sample_id", "_b.read_id", "_b.seq", "_b.qual",
                       F.col("_b._mq").alias("mean_quality"), "dup_count")


# --- adapters ------------------------------------------------------------------------------------
def adapter_set(spec: str, files: DataFrame) -> DataFrame:
    """SRC15: adapters from a comma list mixing literal sequences and named files.

    Items are trimmed and empty ones dropped; a named file contributes its records; a literal
    becomes ``adapter_<seq>_<i>`` with ``i`` its 1-based position among all items."""
    items = [(i + 1, it.strip()) for i, it in enumerate(spec.split(","))]
    items = [(i, it) for i, it in items if it]
    spark = files.sparkSession
    lit = spark.createDataFrame(items, "item_no int, item string")
    named = (lit.join(files, lit["item"] == files["file_name"], "inner")
                .select("item_no", "adapter_id", "seq"))
    known = files.select(F.col("file_name").alias("item")).distinct()
    literal = (lit.join(known, "item", "left_anti")
                  .select("item_no", F.concat(F.lit("adapter_"), "item", F.lit("_"),
                                              F.col("item_no").cast("string")).alias("adapter_id"),
                          F.upper("item").alias("seq")))
    return named.unionByName(literal)


_HIT = "struct<offset:int,id:string,orient:string,n:int,rank:int>"


def _oriented(adapters: DataFrame, mismatches: int) -> DataFrame:
    """Both orientations of every adapter, for both read ends: (side, id, orient, rank, a, n, q).  ``a`` is the text to be
    found in the window (reversed for the 3' end, whose window is); ``q`` the length of its seeds."""
    order = [F.col(c) for c in (["item_no"] if "item_no" in adapters.columns else []) + ["adapter_id"]]
    base = adapters.withColumn("rank", F.row_number().over(Window.orderBy(*order)) - 1).select(   # one row an adapter
        F.col("adapter_id").alias("id"), "rank", F.upper("seq").alias("s"))
    turned = base.select("id", "rank", F.explode(F.array(F.struct(F.lit("+").alias("orient"), F.col("s").alias("s")),
                                                         F.struct(F.lit("-").alias("orient"), NM.revcomp(F.col("s")).alias("s")))).alias("x"))
    both = turned.select("id", "rank", "x.orient", F.explode(F.array(
        F.struct(F.lit(5).alias("side"), F.col("x.s").alias("a")), F.struct(F.lit(3).alias("side"), F.reverse("x.s").alias("a")))).alias("y"))
    n = F.length("y.a")
    return both.select("y.side", "id", "orient", "rank", "y.a", n.alias("n"), F.least(F.floor(n / (mismatches + 1)), F.lit(SEED)).cast("int").alias("q"))


def find_adapters(reads: DataFrame, adapters: DataFrame, window: int = ADAPTER_WINDOW,
                  mismatches: int = ADAPTER_MISMATCHES) -> DataFrame:
    """Best adapter hit at each end of every read: ``hit5`` / ``hit3`` structs
    ``(offset, id, orient, n, rank)`` — lowest offset, then adapter id, then orientation.  The 3' offset
    counts bases after the adapter (searched on the reversed read).  Only the two end windows
    of ``adapter length + window`` bases are scanned.

    Pigeonhole seeds: an adapter is cut into ``mismatches + 1`` pieces, and a hit has one of them unchanged.  The starts of
    the pieces are joined with equal stretches of the windows, and what meets is verified by counting mismatches, so the
    set may have any size and nothing of it but its lengths comes to the driver.  A set of up to ``SEED_ROWS`` seeds is
    sent to every task, so no stretch of a read moves; with a larger one the stretches meet the seeds in a shuffle.
    Reads themselves move once, to meet their hits."""
    ads = _oriented(adapters, mismatches)
    shape = adapters.agg(F.max(F.length("seq")), F.min(F.length("seq")), F.count("*"), F.collect_set(
        F.least(F.floor(F.length("seq") / (mismatches + 1)), F.lit(SEED)).cast("int"))).first()
    if shape[0] is None:
        none = F.lit(None).cast(_HIT)
        return reads.withColumn("hit5", none).withColumn("hit3", none)
    if shape[1] <= mismatches:
        raise ValueError(f"an adapter of {shape[1]} bases fits anywhere with {mismatches} mismatches")
    span = shape[0] + window
    lengths = sorted(shape[3])
    piece = F.floor(F.col("n") / (mismatches + 1)).cast("int")
    seeds = ads.select("*", F.explode(F.transform(F.sequence(F.lit(0), F.lit(mismatches)), lambda j: j * piece)).alias("p")).withColumn(
        "seed", F.expr("substring(a, p + 1, q)"))
    if 4 * (mismatches + 1) * shape[2] <= SEED_ROWS:      # two orientations, two ends
        seeds = F.broadcast(seeds)

    w5, w3 = F.substring("seq", 1, span), F.substring(F.reverse("seq"), 1, span)
    mark = F.xxhash64(w5, w3)
    ends = reads.select("sample_id", "read_id", mark.alias("mark"), F.explode(F.array(
        F.struct(F.lit(5).alias("side"), w5.alias("w")), F.struct(F.lit(3).alias("side"), w3.alias("w")))).alias("e"))
    ends = ends.select("sample_id", "read_id", "mark", "e.side", "e.w")
    cut = lambda q: F.transform(F.sequence(F.lit(0), F.length("w") - q), lambda i: F.struct(
        F.lit(q).alias("q"), i.alias("i"), F.substring(F.col("w"), i + 1, F.lit(q)).alias("seed")))
    stretches = F.flatten(F.array(*[F.when(F.length("w") >= q, cut(q)).otherwise(F.array().cast(
        "array<struct<q:int,i:int,seed:string>>")) for q in lengths]))
    met = (ends.select("*", F.explode(stretches).alias("x")).select("sample_id", "read_id", "mark", "side", "w", "x.*")
           .join(seeds, ["side", "q", "seed"]).withColumn("offset", F.col("i") - F.col("p"))
           .filter((F.col("offset") >= 0) & (F.col("offset") <= window) & (F.col("offset") + F.col("n") <= F.length("w"))))
    unlike = F.zip_with(F.split(F.expr("substring(w, offset + 1, n)"), ""), F.split("a", ""), lambda x, y: x != y)
    hit = F.struct("offset", "id", "orient", "n", "rank")
    best = met.filter(F.size(F.filter(unlike, lambda x: x)) <= mismatches).groupBy("sample_id", "read_id", "mark").agg(
        F.min(F.when(F.col("side") == 5, hit)).alias("hit5"), F.min(F.when(F.col("side") == 3, hit)).alias("hit3"))
    best = best.select(F.col("sample_id").alias("_s"), F.col("read_id").alias("_r"), F.col("mark").alias("_m"), "hit5", "hit3")
    same = F.col("sample_id").eqNullSafe(F.col("_s")) & F.col("read_id").eqNullSafe(F.col("_r")) & (mark == F.col("_m"))
    return reads.join(best, same, "left").drop("_s", "_r", "_m")


def trim_adapters(reads: DataFrame, adapters: DataFrame, preset: str = "ASYMMETRIC",
                  window: int = ADAPTER_WINDOW, mismatches: int = ADAPTER_MISMATCHES,
                  neighbors: bool = False) -> DataFrame:
    """SEQ1: reads with adapters at both ends fitting the preset are cut to the insert.

    SYMMETRIC: the same adapter at both ends; ASYMMETRIC: two different adapters; with
    ``neighbors`` an asymmetric pair must be adjacent in the adapter list.  Other reads
    are not written (``outcome = 'none'``).  Returns all reads with ``outcome`` and, for the
    trimmed ones, the trimmed ``seq``/``qual``."""
    preset = preset.upper()
    if preset not in ("SYMMETRIC", "ASYMMETRIC"):
        raise ValueError(f"unknown preset {preset}")
    h = find_adapters(reads, adapters, window, mismatches)
    both = F.col("hit5").isNotNull() & F.col("hit3").isNotNull()
    same = F.col("hit5.id") == F.col("hit3.id")
    fits = both & (same if preset == "SYMMETRIC" else ~same)
    if neighbors and preset == "ASYMMETRIC":
        fits = fits & (F.abs(F.col("hit5.rank") - F.col("hit3.rank")) == 1)
    start = F.col("hit5.offset") + F.col("hit5.n")          # 0-based first kept base
    stop = F.length("seq") - F.col("hit3.offset") - F.col("hit3.n")
    keep = fits & (stop > start)
    cut = lambda c: F.substring(F.col(c), start + 1, stop - start)
    return (h.withColumn("outcome", F.when(keep, "trimmed").otherwise("none"))
             .withColumn("seq", F.when(keep, cut("seq")))
             .withColumn("qual", F.when(keep, cut("qual")))
             .withColumn("adapter5", F.col("hit5.id")).withColumn("adapter3", F.col("hit3.id"))
             .drop("hit5", "hit3"))


def peek_adapters(reads: DataFrame, adapters: DataFrame,
                  min_share: float = PEEK_MIN_SHARE, window: int = ADAPTER_WINDOW,
                  mismatches: int = ADAPTER_MISMATCHES) -> DataFrame:
    """SEQ2: adapters seen (at either end) in at least ``min_share`` of a sample's reads (all of them)."""
    p = find_adapters(reads, adapters, window, mismatches)
    seen = p.select("sample_id", "read_id", F.explode(F.array_distinct(F.array_compact(
        F.array(F.col("hit5.id"), F.col("hit3.id"))))).alias("adapter_id"))
    tot = p.groupBy("sample_id").agg(F.count("*").alias("_n"))
    c = seen.groupBy("sample_id", "adapter_id").agg(F.countDistinct("read_id").alias("n_reads"))
    return (c.join(tot, "sample_id").withColumn("share", F.col("n_reads") / F.col("_n"))
             .filter(F.col("share") >= min_share).drop("_n"))


def sample_outcome(trimmed: DataFrame) -> DataFrame:
    """Per sample: 'trimmed' when some read was written, else 'unchanged' (input copied)."""
    return (trimmed.groupBy("sample_id").agg(
                F.sum(F.when(F.col("outcome") == "trimmed", 1).otherwise(0)).cast("bigint").alias("n_trimmed"),
                F.count("*").alias("n_reads"))
            .withColumn("outcome", F.when(F.col("n_trimmed") > 0, "trimmed").otherwise("unchanged")))


# --- k-mer screen --------------------------------------------------------------------------------
def kmers(df: DataFrame, id_cols: list[str], k: int = KMER, seq: str = "seq", chunk: int = KMER_CHUNK) -> DataFrame:
    """All k-mers of whole sequences, as ASCII byte strings.

    * A sequence is cut into pieces of ``chunk`` k-mers that overlap by k - 1 bases, and those into pieces of
      ``KMER_PIECE``, one row each, so no row holds all k-mers of a long contig.
    * A row's binary value is copied whole whenever a part of it is taken, so k-mers are cut from the small pieces
      alone: a cut costs the same whatever the sequence's length.
    * The pieces' k-mers are told by position, and taken in the projection behind the ``explode``.  (Inputs arriving
      in very few partitions should be spread over the task slots first — ``session.spread``; the domain views do it.)"""
    b = df.filter(F.length(seq) >= k).select(*id_cols, F.encode(F.col(seq), "US-ASCII").alias("_b"))
    pieces = lambda n: F.transform(F.sequence(F.lit(0), F.length("_b") - k, F.lit(n)),
                                   lambda i: F.substring(F.col("_b"), i + 1, n + k - 1))
    b = b.select(*id_cols, F.explode(pieces(chunk)).alias("_b"))
    b = b.select(*id_cols, F.explode(pieces(min(chunk, KMER_PIECE))).alias("_b"))
    at = b.select(*id_cols, "_b", F.explode(F.sequence(F.lit(0), F.length("_b") - k)).alias("_i"))
    return at.select(*id_cols, F.substring(F.col("_b"), F.col("_i") + 1, F.lit(k)).alias("kmer"))


def kmer_screen(reads: DataFrame, reference: DataFrame, k: int = KMER, min_share: float = 0.1) -> DataFrame:
    """SEQ6: per read, k-mer positions and those whose k-mer occurs in the reference;
    ``screened = shared / total >= min_share``.  Reads shorter than k are never screened."""
    rk = kmers(reads, ["sample_id", "read_id"], k)
    ref = kmers(reference, [], k).select("kmer").distinct()
    # the planner broadcasts the reference set below the session's byte threshold; a larger one is a
    # shuffle join (AQE splits skewed k-mers)
    shared = rk.join(ref, "kmer", "left_semi").groupBy("sample_id", "read_id").agg(
        F.count("*").alias("n_shared"))
    total = reads.select("sample_id", "read_id",
                         F.greatest(F.length("seq") - k + 1, F.lit(0)).cast("bigint").alias("n_kmers"))
    out = total.join(shared, ["sample_id", "read_id"], "left").fillna(0, ["n_shared"])
    return out.withColumn("screened", (F.col("n_kmers") > 0)
                          & (F.col("n_shared") >= F.lit(min_share) * F.col("n_kmers")))

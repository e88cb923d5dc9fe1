"""Coverage and depth tables (AGG4-AGG8).

Inputs are alignments that already carry half-open reference coordinates ``start, stop``
(``functions.cigar.with_alignment_coords``).  Per-sample tables are keyed by
``(sample_id, ref_id)``; a reference is a genome, or a contig whose genome a table names.

Zero rows: like the feature tables, results are sparse — a (sample, genome) pair with no
passing alignment has no row.  Emitting every pair would be a samples x genomes product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import intervals as IV
from ..functions import cigar as C


def contig_depth(aln: DataFrame, lengths: DataFrame) -> DataFrame:
    """AGG4: per (sample, contig) mean depth = aligned reference bases / contig length, and
    the number of alignments."""
    span = C.reference_span("cigar")
    per = (aln.filter(F.col("ref_id") != "*")
              .groupBy("sample_id", "ref_id")
              .agg(F.sum(span).alias("_bases"), F.count("*").alias("read_count")))
    return (per.join(lengths.select("ref_id", "length"), "ref_id")
               .select("sample_id", F.col("ref_id").alias("contig_id"),
                       F.when(F.col("length") > 0, F.col("_bases") / F.col("length")).alias("mean"),
                       "read_count"))


def genome_depth(aln: DataFrame, lengths: DataFrame, lo: float = 0.05, hi: float = 0.95,
                 chunk: int = IV.DEFAULT_CHUNK, genomes: DataFrame | None = None, end_exclusion: int = 0) -> DataFrame:
    """AGG5: per (sample, genome): covered_bases, trimmed_mean, mean, length, read_count.

    ``genomes(ref_id, genome_id)`` names the genome of each contig (without it a reference is a genome of
    its own); depth runs are made per contig, their histogram per genome.  ``end_exclusion`` bases at both
    ends of a contig count neither as covered nor as length.  One depth-run pipeline feeds one histogram
    pass (``intervals.depth_stats``); the read count is a separate partial aggregate over the same alignments.
    Alignments to a reference without a length are reported by ``unknown_references``."""
    keys, e = ["sample_id", "genome_id"], end_exclusion
    a = C.with_alignment_coords(aln.filter(F.col("ref_id") != "*"))
    runs = IV.depth_runs(a, ["sample_id", "ref_id"], chunk=chunk)
    L = lengths.select("ref_id", "length")
    names = (L.join(genomes.select("ref_id", "genome_id"), "ref_id") if genomes is not None
             else L.withColumn("genome_id", F.col("ref_id")))
    if e or genomes is not None:
        runs = runs.join(names, "ref_id")
        if e:
            runs = (runs.withColumn("start", F.greatest("start", F.lit(e)))
                        .withColumn("stop", F.least("stop", F.col("length") - e)).filter("stop > start"))
        a = a.join(names.select("ref_id", "genome_id"), "ref_id")
    else:
        runs, a = runs.withColumnRenamed("ref_id", "genome_id"), a.withColumnRenamed("ref_id", "genome_id")
    total = names.groupBy("genome_id").agg(
        F.sum(F.greatest(F.col("length") - 2 * e, F.lit(0))).cast("bigint").alias("length"))
    stats = IV.depth_stats(runs, total, keys, lo, hi)
    counts = a.groupBy(*keys).agg(F.countDistinct("read_id").alias("read_count"))
    return (stats.join(counts, keys)
                 .select("sample_id", "genome_id", "covered_bases", "trimmed_mean",
                         F.when(F.col("length") > 0, F.col("depth_sum") / F.col("length"))
                          .otherwise(F.lit(0.0)).alias("mean"),
                         "length", "read_count"))


def unknown_references(aln: DataFrame, lengths: DataFrame) -> DataFrame:
    """References with alignments but no length: (sample_id, ref_id, n_alignments), the error rows of the depth tables."""
    lost = aln.filter(F.col("ref_id") != "*").join(lengths.select("ref_id"), "ref_id", "left_anti")
    return lost.groupBy("sample_id", "ref_id").agg(F.count("*").alias("n_alignments"))


def coverage_summary(depth: DataFrame) -> DataFrame:
    """AGG6 / FLT14: ``mag_id, covered, length, percent_covered`` for length > 0.

    ``percent_covered`` is a fraction (covered / length) despite its name."""
    return (depth.filter(F.col("length") > 0)
                 .select("sample_id", F.col("genome_id").alias("mag_id"),
                         F.col("covered_bases").alias("covered"), "length",
                         (F.col("covered_bases") / F.col("length")).alias("percent_covered")))


def covered_intervals(aln: DataFrame, chunk: int = IV.DEFAULT_CHUNK) -> DataFrame:
    """AGG7: merged covered intervals per (sample, reference)."""
    a = C.with_alignment_coords(aln.filter(F.col("ref_id") != "*"))
    return IV.merge_intervals(a, ["sample_id", "ref_id"], chunk=chunk)


def consolidate(intervals: DataFrame, lengths: DataFrame, chunk: int = IV.DEFAULT_CHUNK) -> DataFrame:
    """AGG8: coverage of each reference over all samples together (union of the per-sample
    intervals) and the per-sample figure beside it.

    Output: ``sample_id`` (``'*'`` for the all-sample row), ref_id, covered, length, fraction."""
    L = lengths.select("ref_id", "length")
    per_sample = intervals.groupBy("sample_id", "ref_id").agg(
        F.sum(F.col("stop") - F.col("start")).alias("covered"))
    pooled = (IV.merge_intervals(intervals, ["ref_id"], chunk=chunk)
                .groupBy("ref_id").agg(F.sum(F.col("stop") - F.col("start")).alias("covered"))
                .withColumn("sample_id", F.lit("*")))
    # Spark takes the union of parts dealt out alike by ref_id for dealt out, and may not find it so when it runs: deal it out here
    both = per_sample.unionByName(pooled).repartition("ref_id").join(L, "ref_id")
    return both.select("sample_id", "ref_id", "covered", "length",
                       F.when(F.col("length") > 0, F.col("covered") / F.col("length")).alias("fraction"))

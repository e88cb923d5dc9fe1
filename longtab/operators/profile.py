"""Per-sample feature profiles (AGG1-AGG3): genome, gene and functional tables.

Profiles are long COO tables ``(sample_id, feature_id, value)``.

Counting rule (our fixed choice): a read that hits k distinct features adds 1/k to each;
the per (sample, feature) sum is rounded half-to-even to an integer and zeros are dropped.
The inner ``round(x, 9)`` makes the rounding independent of summation order.

Plan shape: one shuffle keyed by (sample, read) to find each read's feature set (bounded by
the read's alignments), then an ``explode`` and a partially aggregated (map-side combined)
sum keyed by (sample, feature).  A hot feature only costs its partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import intervals as IV


def split_counts(hits: DataFrame, feature_col: str, read_col: str = "read_id",
                 sample_col: str = "sample_id", rounded: bool = True) -> DataFrame:
    per_read = (hits.groupBy(sample_col, read_col)
                    .agg(F.array_distinct(F.collect_list(feature_col)).alias("_f")))
    shares = per_read.select(sample_col, F.explode("_f").alias("feature_id"),
                             (F.lit(1.0) / F.size("_f")).alias("_w"))
    summed = shares.groupBy(sample_col, "feature_id").agg(F.sum("_w").alias("value"))
    if not rounded:
        return summed
    return (summed.withColumn("value", F.bround(F.round("value", 9), 0))
                  .filter(F.col("value") != 0))


def genome_profile(aln: DataFrame) -> DataFrame:
    """AGG1: reads per (sample, reference) with the 1/k split, rank ``none``."""
    return split_counts(aln.filter(F.col("ref_id") != "*"), "ref_id")


def read_gene_hits(aln: DataFrame, genes: DataFrame, min_overlap_pct: int = 80,
                   bin_size: int = IV.DEFAULT_BIN) -> DataFrame:
    """REL6: alignments x genes on the same reference whose overlap covers at least
    ``min_overlap_pct`` % of the alignment's reference span (integer test)."""
    a = aln.select("sample_id", "read_id", "ref_id", "start", "stop")
    g = genes.select("ref_id", "gene_id", F.col("start").alias("g_start"), F.col("stop").alias("g_stop"))
    pairs = IV.overlap_join(a, g, ["ref_id"], ("start", "stop"), ("g_start", "g_stop"), bin_size)
    ov = F.least("stop", "g_stop") - F.greatest("start", "g_start")
    return pairs.filter(ov * 100 >= F.lit(min_overlap_pct) * (F.col("stop") - F.col("start")))


def gene_profile(aln: DataFrame, genes: DataFrame, **kw) -> DataFrame:
    """AGG2: per-gene profile, same split rule over the matched genes."""
    return split_counts(read_gene_hits(aln, genes, **kw), "gene_id")


def collapse(table: DataFrame, mapping: DataFrame, divide: bool = False) -> DataFrame:
    """AGG3 / REL7: move counts from source features to target features.

    Each target gets the full count (``divide=True`` splits it evenly); features with no
    mapping are dropped.  Whether the map is broadcast is up to the session's byte threshold.
    """
    m = mapping.select(F.col("source").alias("feature_id"), F.col("target"))
    if divide:
        m = m.withColumn("_k", F.count("*").over(Window.partitionBy("feature_id")))
    joined = table.join(m, "feature_id")
    val = F.col("value") / F.col("_k") if divide else F.col("value")
    return (joined.groupBy("sample_id", F.col("target").alias("feature_id"))
                  .agg(F.sum(val).alias("value")))


# The published functional chain: gene -> KO -> EC; KO -> reaction -> module -> pathway.
FUNCTION_CHAIN = (("ko", "gene", "ko"), ("ec", "ko", "ec"), ("reaction", "ko", "reaction"),
                  ("module", "reaction", "module"), ("pathway", "module", "pathway"))
PUBLISHED_RANKS = ("none", "per-gene", "ko", "ec", "pathway")


def functional_tables(gene_table: DataFrame, maps: DataFrame) -> dict[str, DataFrame]:
    """All collapsed ranks, each stage reading the previous (rounded) table lazily."""
    out = {"gene": gene_table}
    mb = maps
    for name, src, map_name in FUNCTION_CHAIN:
        out[name] = collapse(out[src], mb.filter(F.col("map") == map_name))
    return out

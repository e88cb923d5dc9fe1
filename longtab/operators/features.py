"""Feature tables (SET1, SET4, SET6, REL8, SRC12, SRC13, FLT11).

A feature table is the long COO form ``(sample_id, feature_id, value)``; a wide matrix is
only an export format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Merge types and the ranks each one publishes.
MERGE_RANKS = {
    "syndna": ("syndna",),
    "counts": ("counts",),
    "woltka": ("none", "per-gene", "ko", "ec", "pathway"),
}


def ranks_for(merge_type: str) -> tuple[str, ...]:
    """SET6: case-insensitive merge type -> ranks; unknown types are an error."""
    try:
        return MERGE_RANKS[merge_type.lower()]
    except KeyError:
        raise ValueError(f"unknown merge type {merge_type!r}; known: {sorted(MERGE_RANKS)}") from None


def merge_tables(tables: DataFrame, table_col: str = "table_id") -> DataFrame:
    """SET1: union of per-table COO rows along samples.  Tables without rows or with an
    all-zero total contribute nothing.  Sample sets must be disjoint: a sample of several tables is
    left out (``duplicate_samples`` reports it as a row), never added up."""
    m = tables.groupBy("sample_id", "feature_id").agg(
        F.sum("value").alias("value"), F.min(table_col).alias("_lo"), F.max(table_col).alias("_hi"))
    clash = (m.groupBy("sample_id").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
              .filter(F.col("_lo") != F.col("_hi")).select("sample_id"))
    return m.join(clash, "sample_id", "left_anti").filter(F.col("value") != 0).select("sample_id", "feature_id", "value")


def duplicate_samples(tables: DataFrame, table_col: str = "table_id") -> DataFrame:
    """Samples present in more than one input table (a merge error, reported as rows)."""
    return (tables.select(table_col, "sample_id").distinct()
                  .groupBy("sample_id").agg(F.count("*").alias("n_tables"),
                                            F.array_sort(F.collect_set(table_col)).alias("tables"))
                  .filter(F.col("n_tables") > 1))


def merge_ranked(tables: DataFrame, merge_type: str, table_col: str = "table_id") -> DataFrame:
    """SET6 + SET1: keep the ranks of ``merge_type`` (absent ranks just yield no rows) and merge
    each rank; the rank stays a column so the sink can ``partitionBy('rank')``.  As in ``merge_tables`` a sample that several
    tables hold in a rank is left out of it, never added up; without ``table_col`` all rows are one table."""
    ranks = list(ranks_for(merge_type))
    t = tables.filter(F.lower(F.col("rank")).isin(ranks)).withColumn("rank", F.lower(F.col("rank")))
    if table_col not in tables.columns:
        t = t.withColumn(table_col, F.lit(None).cast("string"))
    m = t.groupBy("rank", "sample_id", "feature_id").agg(
        F.sum("value").alias("value"), F.min(table_col).alias("_lo"), F.max(table_col).alias("_hi"))
    clash = (m.groupBy("rank", "sample_id").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
              .filter(F.col("_lo") != F.col("_hi")).select("rank", "sample_id"))
    return (m.join(clash, ["rank", "sample_id"], "left_anti").filter(F.col("value") != 0)
             .select("rank", "sample_id", "feature_id", "value"))


# Fixed pattern: a label right after ``(`` or ``,`` (group 2), unquoted or single-quoted with
# ``''`` for a quote; the second branch swallows quoted inner-node labels so their text is
# never read as tips; the third swallows ``[...]`` comments.
TIP_PATTERN = r"([(,])('(?:[^']|'')*'|[^(),:;'\[]+)|'(?:[^']|'')*'|\[[^\]]*\]"


def tip_label(raw: Column) -> Column:
    """Quoted labels lose their quotes and ``''`` becomes ``'``; spaces become underscores."""
    inner = F.regexp_replace(F.substring(raw, F.lit(2), F.length(raw) - 2), "''", "'")
    return F.regexp_replace(F.when(raw.startswith("'"), inner).otherwise(raw), " ", "_")


def tree_tips(trees: DataFrame, col: str = "newick") -> DataFrame:
    """SRC13: tip names of Newick texts.  A tip is the label right after ``(`` or ``,``;
    inner-node labels (after ``)``) are not tips; quoted labels may hold any character.

    One regex pass per text (linear in its length); the exploded labels are de-duplicated by
    a shuffle, so the tip list never has to fit in one group."""
    raw = trees.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(TIP_PATTERN), 2)).alias("_raw"))
    return (raw.filter(F.col("_raw") != "").select(tip_label(F.col("_raw")).alias("tip"))
               .filter(F.col("tip") != "").distinct())


def tree_filter(table: DataFrame, tips: DataFrame) -> DataFrame:
    """REL8: keep features that are tips of the tree."""
    return table.join(tips.select(F.col("tip").alias("feature_id")), "feature_id", "left_semi")


def tree_removed(table: DataFrame, tips: DataFrame) -> DataFrame:
    """SET4 / SRC20: feature ids of the table that are not tips (the removed-features report)."""
    feats = table.select("feature_id").distinct()
    return feats.join(tips.select(F.col("tip").alias("feature_id")), "feature_id", "left_anti")


def shape_changed(table: DataFrame, tips: DataFrame) -> bool:
    """Whether the filter removes anything (only then is the table rewritten); reads one row."""
    return len(tree_removed(table, tips).take(1)) > 0


def to_wide(table: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """SRC12 export: features x samples.  Pass ``samples`` to skip the distinct-values job."""
    return table.groupBy("feature_id").pivot("sample_id", samples).agg(F.sum("value"))


def from_wide(wide: DataFrame, id_col: str = "feature_id") -> DataFrame:
    """SRC12 import: a wide TSV-style frame back to COO rows (zeros and nulls dropped)."""
    cols = [c for c in wide.columns if c != id_col]
    long = wide.unpivot([id_col], cols, "sample_id", "value")
    return (long.filter(F.col("value").isNotNull() & (F.col("value") != 0))
                .select("sample_id", id_col, F.col("value").cast("double").alias("value")))


def sample_totals(manifest: DataFrame, counts: DataFrame, value_col: str = "value") -> DataFrame:
    """FLT11 / AGG15: per-sample total with ``coalesce(sum, 0)``; zero totals are 'empty'
    (an empty table counts as zero, unlike a text test on an empty sum)."""
    tot = counts.groupBy("sample_id").agg(F.sum(value_col).alias("_t"))
    return (manifest.select("sample_id").distinct().join(tot, "sample_id", "left")
                    .select("sample_id", F.coalesce("_t", F.lit(0)).cast("bigint").alias("total"))
                    .withColumn("state", F.when(F.col("total") == 0, "empty").otherwise("ok")))

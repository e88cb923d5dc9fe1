"""File name -> sample lookup (REL1, WIN5) and the pooled analysis manifest (REL11, SET5).

Rule, in order: the exact name; else the longest prefix that ends right before a ``_``;
else the longest prefix that ends right before a ``.``; else the earliest-inserted run
prefix that the name starts with; else no match (an error row).

All four tiers are one candidate explode + one equi-join + one min-by per file: the last
tier enumerates every prefix of the name instead of a nested-loop ``startswith`` join, so
no theta join is ever planned.  A duplicated run prefix keeps its last sample at the
position of its first occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def build_lookup(prep: DataFrame, key: str = "run_prefix", value: str = "sample_name",
                 order: str = "ord", scope: tuple[str, ...] = ()) -> DataFrame:
    """One row per run prefix (within ``scope`` columns, e.g. the artifact a preparation belongs to)."""
    return prep.groupBy(*scope, F.col(key).alias("run_prefix")).agg(
        F.max_by(value, order).alias("sample_id"), F.min(order).alias("ord"))


def _cut_prefixes(name, sep: str, tier: int):
    pos = F.filter(F.sequence(F.lit(1), F.length(name)), lambda i: F.substring(name, i, 1) == sep)
    return F.transform(pos, lambda i: F.struct(F.lit(tier).alias("tier"),
                                               F.substring(name, F.lit(1), i - 1).alias("pre"),
                                               (1 - i).cast("bigint").alias("rk")))


def match_files(files: DataFrame, lookup: DataFrame, name_col: str = "file_name", scope: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``sample_id`` (null when nothing matches) and ``tier`` (0-3) to ``files``; with ``scope`` a file
    meets the run prefixes of its own scope only."""
    name = F.col(name_col)
    exact = F.array(F.struct(F.lit(0).alias("tier"), name.alias("pre"),
                             F.lit(0).cast("bigint").alias("rk")))
    every = F.transform(F.sequence(F.lit(1), F.length(name)),
                        lambda i: F.struct(F.lit(3).alias("tier"),
                                           F.substring(name, F.lit(1), i).alias("pre"),
                                           F.lit(0).cast("bigint").alias("rk")))
    cands = F.concat(exact, _cut_prefixes(name, "_", 1), _cut_prefixes(name, ".", 2), every)
    keyed = files.select(*scope, name_col).distinct()
    ex = keyed.select(*scope, name_col, F.explode(cands).alias("c")).select(*scope, name_col, "c.tier", "c.pre", "c.rk")
    lk = lookup.select(*scope, F.col("run_prefix").alias("pre"), "sample_id", "ord")
    hit = ex.join(lk, [*scope, "pre"])
    rank = F.struct(F.col("tier"), F.when(F.col("tier") == 3, F.col("ord")).otherwise(F.col("rk")))
    best = hit.groupBy(*scope, name_col).agg(F.min_by(F.struct("sample_id", "tier"), rank).alias("_b"))
    return (files.join(best, [*scope, name_col], "left")
                 .withColumn("sample_id", F.col("_b.sample_id"))
                 .withColumn("tier", F.col("_b.tier")).drop("_b"))


def basename(path_col) -> F.Column:
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.element_at(F.split(p, "/"), -1)


def analysis_manifest(matched: DataFrame, artifact_col: str = "artifact_id",
                      path_col: str = "file_name") -> DataFrame:
    """REL11/SET5/AGG17: one task row per (artifact, sample, file); unmatched files are left
    to the error side.  The task count is the row count of this table."""
    return (matched.filter(F.col("sample_id").isNotNull())
                   .select("sample_id", F.col(path_col).alias("path"), artifact_col))


def expand_artifacts(requested: DataFrame, tree: DataFrame, files: DataFrame, preps: DataFrame,
                     kind: str = "fwd") -> tuple[DataFrame, DataFrame]:
    """REL11 from its inputs: (tasks, errors).

    ``requested(artifact_id)`` -> its parents in ``tree(artifact_id, parent_id)`` -> their files of ``kind`` in
    ``files(artifact_id, path, kind)`` -> samples by the parent's own ``preps(artifact_id, sample_name, run_prefix, ord)``.
    Tasks: (artifact_id, parent_id, sample_id, path), one per file; their number is the job's.  Errors: (artifact_id, parent_id, path,
    reason), one row where a level ends: no parents, no files, no preparation, no sample.  Repeated requests and edges count once."""
    up = tree.select("artifact_id", "parent_id").filter("parent_id IS NOT NULL").distinct()
    pairs = requested.select("artifact_id").distinct().join(up, "artifact_id", "left")
    of = files.filter(F.col("kind") == kind).select(F.col("artifact_id").alias("parent_id"), "path").distinct()
    known = preps.select(F.col("artifact_id").alias("parent_id")).distinct().withColumn("prepared", F.lit(True))
    lookup = build_lookup(preps.withColumnRenamed("artifact_id", "parent_id"), scope=("parent_id",))
    named = match_files(of.withColumn("_name", basename("path")), lookup, "_name", scope=("parent_id",))
    rows = pairs.join(named.select("parent_id", "path", "sample_id"), "parent_id", "left").join(known, "parent_id", "left")
    reason = (F.when(F.col("parent_id").isNull(), "no parents").when(F.col("path").isNull(), "no files")
              .when(F.col("prepared").isNull(), "no preparation").when(F.col("sample_id").isNull(), "no sample"))
    rows = rows.withColumn("reason", reason)
    return (rows.filter(F.col("reason").isNull()).select("artifact_id", "parent_id", "sample_id", "path"),
            rows.filter(F.col("reason").isNotNull()).select("artifact_id", "parent_id", "path", "reason"))

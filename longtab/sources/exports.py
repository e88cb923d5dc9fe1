"""Globally ordered exports (SRT1, SRT2, SRT5): range-partitioned, sorted parts and a manifest of their key ranges.

Bounds of the ranges are sampled by Spark, every part is sorted by itself, and parts are numbered in key order, so the
files in name order are one sorted sequence: nothing is sorted in one task.  Rows of one key are ordered by the
``ties`` columns, which the ranges use too, so a key that holds a third of all rows is split among parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, keys: list[str], ties: list[str] = (), parts: int | None = None) -> DataFrame:
    """Writes ``df`` as Parquet in ascending order of ``keys`` and then ``ties`` (nulls first); returns ``key_ranges``."""
    order = [F.col(c).asc_nulls_first() for c in [*keys, *ties]]
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return key_ranges(df.sparkSession, path, keys)


def key_ranges(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The manifest of a sorted export: (file_name, rows, first, last, before), one row per part with rows; ``before`` counts the
    rows of the parts in front of it."""
    key = F.struct(*keys)
    per = (spark.read.parquet(path).select(*keys, F.col("_metadata.file_name").alias("file_name"))
           .groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last")))
    ahead = Window.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)      # one row a file
    return per.withColumn("before", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))


def read_sorted(spark: SparkSession, path: str, keys: list[str], row_no: str = "row_no") -> DataFrame:
    """The rows of a sorted export with their place (from 1) in the whole order."""
    rows = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_name")).withColumn("_index", F.col("_metadata.row_index"))
    place = key_ranges(spark, path, keys).select(F.col("file_name").alias("_file"), "before")
    return rows.join(place, "_file").withColumn(row_no, F.col("before") + F.col("_index") + 1).drop("_file", "_index", "before")


def write_sorted_text(df: DataFrame, path: str, line: str, keys: list[str], ties: list[str] = (), parts: int | None = None,
                      compression: str = "gzip") -> None:
    """The ``line`` column of ``df`` as text files in the order of ``keys`` and ``ties``."""
    order = [F.col(c).asc_nulls_first() for c in [*keys, *ties]]
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).select(line).write.mode("overwrite").option("compression", compression).text(path)

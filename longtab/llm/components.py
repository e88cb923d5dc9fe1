"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtab.session import cut_lineage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    down = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _sign(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of bigint nodes, any order, repeats and loops allowed -> ``(node, component)``:
    the smallest node reachable, for every node that some edge joins to another one.

    Every round leaves each node linked to smaller ones only and shortens the paths; the loop ends
    when a round changes nothing (every node points at its component's smallest).  Each round's
    links are a written table in the shared folder, so a lost executor costs one round at most.
    Nothing but a count and a checksum reaches the driver.  No edges: an empty table."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = cut_lineage(e, "links")
    sign = _sign(e)
    while True:
        nxt = cut_lineage(_small_star(_large_star(e)), "links")
        now = _sign(nxt)
        if now == sign:
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                nxt.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        e, sign = nxt, now

"""Mixing sources to target weights by systematic sampling (operator 8).

Every source gets a target of words; each of its documents has target / source size expected copies.
Documents of a source stand in a fixed order (size class, then md5 of the id); their expected copies are
summed up, one random offset per source is added, and a document is emitted once for every whole number
its interval crosses.  Size classes in order act as strata, so the words taken come close to the target.
As all documents of a source expect the same number of copies, the prefix sum is rank x rate, exact at
any number of rows.

Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share ``share`` times all words;
none gets more than ``most`` times its size, what is above goes to the others by weight.

The rank is never taken over a whole source in one task: rows are ranked inside chunks (source, size
class, md5 prefix as long as that class needs), chunk counts are summed up, and rows add their chunk's
offset.  Order and offset depend on the data and a seed only, so reruns agree.

Null text has size 0; a source without words has target 0 and takes nothing; null is a source of its own.
Rows that repeat an id, source and size are alike and share the copies of their ranks.  Other columns don't matter to
the decision, whatever they are called; ``mixed`` carries them on.  An empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.common import WORD, fresh
from longtab.session import cut_lineage

SHARE, MOST, WEIGHTS, SEED = 1.5, 2, (5, 2, 1), "mix"
CHUNK_ROWS = 1000
SALTS = 256              # lots that rows alike in id, source and size are spread over


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """``sized(source, size)`` -> (source, source_size, target, rate, shift), one row per source."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = by.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("w").over(after))
    levels = weighed.withColumn("level", level).withColumn("k", F.row_number().over(order))
    fits = F.col("level") <= F.col("cap") / F.col("w")
    met = levels.withColumn("level", F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("k"))).over(Window.partitionBy()))
    name = F.concat(F.lit(seed), F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit(":"), "source")))
    return met.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"),
        (F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("long") / 1048576.0).alias("shift")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def ranked(sized: DataFrame) -> DataFrame:
    """``sized(no, doc_id, source, size)`` plus ``at``: the row's place (from 1) in its source's order; ``no`` is unique.

    Rows alike in id, source and size are counted in ``SALTS`` lots, and lots are what chunks rank, each with its number of
    rows: an id that a third of all rows share (or lack) is spread over its lots."""
    same = (F.col("source").eqNullSafe(F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z"))
            & (F.col("salt") == F.col("t")))
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("no"), F.lit(SALTS)).cast("int"))
    lot = ["source", "doc_id", "size", "salt"]
    drop = F.greatest(F.length(F.bin("size")) - 4, F.lit(0))
    lots = salted.groupBy(*lot).agg(F.count(F.lit(1)).alias("held")).withColumn(
        "level", drop * 16 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))")).withColumn(
        "key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    wide = lots.groupBy("source", "level").agg(F.count(F.lit(1)).alias("lots"))
    need = F.greatest(F.lit(0), F.ceil(F.log(F.col("lots") / CHUNK_ROWS) / math.log(16))).cast("int")
    wide = wide.select(F.col("source").alias("s"), F.col("level").alias("l"), need.alias("digits"))
    part = lots.join(wide, F.col("source").eqNullSafe(F.col("s")) & (F.col("level") == F.col("l"))).withColumn(
        "part", F.expr("substring(key, 1, digits)")).drop("s", "l", "digits")
    chunk = ["source", "level", "part"]
    order = Window.partitionBy("source").orderBy("level", "part").rowsBetween(Window.unboundedPreceding, -1)
    start = part.groupBy(*chunk).agg(F.sum("held").alias("rows")).select(
        *[F.col(c).alias(f"c_{c}") for c in chunk], F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*chunk).orderBy("key", "doc_id", "size", "salt").rowsBetween(Window.unboundedPreceding, -1)
    first = (part.withColumn("before", F.coalesce(F.sum("held").over(inside), F.lit(0)))
             .join(start, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("level") == F.col("c_level"))
                   & (F.col("part") == F.col("c_part")))
             .select(*[F.col(c).alias(n) for c, n in zip(lot, "sdzt")], (F.col("before") + F.col("start")).alias("first")))
    turn = F.row_number().over(Window.partitionBy(*lot).orderBy("no"))
    return salted.withColumn("turn", turn).join(first, same).select(
        "no", "doc_id", "source", "size", (F.col("first") + F.col("turn")).alias("at"))


def decide(docs: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row of ``docs(doc_id, text, source)``."""
    sized = cut_lineage(docs.select("doc_id", "source", word_count("text").alias("size"), F.monotonically_increasing_id().alias("no")), "sizes")
    return _copies(sized, share, most, weights, seed).drop("no")


def _copies(sized: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """``decide`` for rows whose words are counted: ``sized(no, doc_id, source, size)``; ``no`` is carried on."""
    goal = targets(sized, share, most, weights, seed).withColumnRenamed("source", "goal_source")
    rows = ranked(sized).join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
    crossed = F.floor(F.col("at") * F.col("rate") + F.col("shift")) - F.floor((F.col("at") - 1) * F.col("rate") + F.col("shift"))
    return rows.select("no", "doc_id", "source", "size", "source_size", "target", F.least(crossed, F.lit(most)).cast("long").alias("copies"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, columns as they were.

    Rows are written once with a number and their size; copies are decided on numbers and sizes alone, and the texts meet
    them once, by number, with the narrow side as the hash table (no text is sorted or put into a window)."""
    cols = docs.columns
    no, size, copies, copy = fresh(docs, "mix_no", "mix_size", "mix_copies", "mix_copy")
    rows = cut_lineage(docs.withColumn(no, F.monotonically_increasing_id()).withColumn(size, word_count("text")), "numbered")
    plan = _copies(rows.select(F.col(no).alias("no"), "doc_id", "source", F.col(size).alias("size")), **settings)
    plan = plan.where("copies > 0").select(F.col("no").alias(no), F.col("copies").cast("int").alias(copies))
    return rows.join(plan.hint("shuffle_hash"), no).withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(*cols)

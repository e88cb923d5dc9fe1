"""Spike-in calibration fit (AGG10): per-sample least squares of log10(known mass) on
log10(counts per million), with the statistics a linear-regression routine reports.

Native aggregates carry the fit (``regr_*``, population moments); the two-sided p-value is the
Student-t tail in closed form for whole degrees of freedom, an expression as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SAMPLE_COUNTS = 1


TAIL_TERMS = 400        # 0.9 ** 400 is below a double's precision


def two_sided_p(t, df) -> Column:
    """Two-sided tail of Student's t for whole degrees of freedom, natively.

    With theta = atan(t / sqrt(df)) the tail is sin(theta) times a series in cos(theta) ** 2 whose first terms belong to the
    inside and whose others are the tail.  The inside is a finite sum; where it is nearly everything
    (cos ** 2 <= 0.9), the tail's own terms are summed instead, so that small values keep their digits."""
    t, df = (F.col(c) if isinstance(c, str) else c for c in (t, df))
    v = df.cast("int")
    cos2 = v / (v + t * t)
    sin = F.sqrt(t * t / (v + t * t))
    odd = v % 2
    n = ((v - odd) / 2).cast("int")     # terms inside, and the tail's first
    # term k over term k - 1: (2k - 1) / 2k for even, 2k / (2k + 1) for odd degrees of freedom
    ratio = lambda k: F.when(odd == 0, (2 * k - 1) / (2 * k)).otherwise(2 * k / (2 * k + 1)) * cos2
    first = F.when(odd == 0, F.lit(1.0)).otherwise(F.sqrt(cos2))
    acc = lambda term, total: F.struct(term.cast("double").alias("term"), total.cast("double").alias("sum"))
    walk = lambda ks, start: F.aggregate(
        ks, start, lambda a, k: acc(a["term"] * ratio(k), a["sum"] + a["term"] * ratio(k)))
    upto = lambda a, b: F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    inside = walk(upto(F.lit(1), n - 1), acc(first, F.when(n > 0, first).otherwise(F.lit(0.0))))["sum"]
    start = F.aggregate(upto(F.lit(1), n), first, lambda a, k: a * ratio(k))
    tail = walk(F.sequence(n + 1, n + TAIL_TERMS), acc(start, start))["sum"]
    scale = F.when(odd == 0, F.lit(1.0)).otherwise(F.lit(2 / math.pi))
    theta = F.when(odd == 0, F.lit(0.0)).otherwise(F.atan2(F.abs(t), F.sqrt(v.cast("double"))))
    p = F.when(cos2 <= 0.9, scale * sin * tail).otherwise(1 - scale * (theta + sin * inside))
    return F.when(df > 0, F.when(F.isnan(t) | t.isNull(), F.lit(None)).when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(p))


def calibrate(counts: DataFrame, min_sample_counts: int = MIN_SAMPLE_COUNTS,
              count_col: str = "read_count", mass_col: str = "mass_ng") -> tuple[DataFrame, DataFrame]:
    """Returns (fits, log): one fit row per sample with enough counts, and one log row per
    sample skipped for having fewer than ``min_sample_counts`` reads."""
    tot = counts.groupBy("sample_id").agg(F.sum(count_col).alias("_total"))
    c = counts.join(tot, "sample_id")
    skipped = (tot.filter(F.col("_total") < min_sample_counts)
                  .select("sample_id", F.col("_total").cast("bigint").alias("total"),
                          F.lit("fewer reads than min_sample_counts").alias("message")))
    c = (c.filter((F.col("_total") >= min_sample_counts) & (F.col(count_col) > 0) & (F.col(mass_col) > 0))
          .withColumn("x", F.log10(F.col(count_col) / F.col("_total") * 1e6))
          .withColumn("y", F.log10(F.col(mass_col))))
    g = c.groupBy("sample_id").agg(
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("_r2"), F.regr_count("y", "x").alias("n"),
        F.var_pop("x").alias("_vx"), F.var_pop("y").alias("_vy"), F.avg("x").alias("_mx"))
    r = F.signum(F.col("slope")) * F.sqrt(F.col("_r2"))
    df = F.col("n") - 2
    g = g.withColumn("rvalue", r)
    stderr = F.when((df > 0) & (F.col("_vx") > 0),
                    F.sqrt((1 - F.col("rvalue") ** 2) * F.col("_vy") / F.col("_vx") / df))
    g = (g.withColumn("stderr", stderr)
          .withColumn("intercept_stderr", F.col("stderr") * F.sqrt(F.col("_vx") + F.col("_mx") ** 2)))
    den = (1 - F.col("rvalue")) * (1 + F.col("rvalue"))
    t = F.col("rvalue") * F.sqrt(df / den)
    g = g.withColumn("_t", F.when((df > 0) & (den > 0), t)
                           .when((df > 0) & (den <= 0), F.lit(float("inf")))).withColumn("pvalue", two_sided_p(F.col("_t"), df))
    fits = g.select("sample_id", "slope", "intercept", "rvalue", "pvalue", "stderr", "intercept_stderr", "n")
    return fits, skipped

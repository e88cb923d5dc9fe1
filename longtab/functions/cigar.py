"""CIGAR arithmetic as native Column expressions (FN1-FN3).

Every CIGAR run is ``<digits><op>``; the sum of the lengths of a set of ops is one
``regexp_extract_all`` plus an ``aggregate`` — no Python, no row-at-a-time UDF.

Definitions (our fixed choices, see the README):

* alignment columns = sum of M, =, X, I, D
* matches = sum of = when the CIGAR has no M, else sum of M, =, X minus (NM - I - D)
* BLAST identity = matches / alignment columns
* query coverage = sum of M, =, X, I over sum of M, =, X, I, S, H
* reference span = sum of M, =, X, D, N;  query span = sum of M, =, X, I, S
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_OPS = "MIDNSHP=X"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def op_sum(cigar, ops: str) -> Column:
    """Sum of the run lengths whose op is one of ``ops`` (one regex pass)."""
    runs = F.regexp_extract_all(_c(cigar), F.lit(r"(\d+)[" + ops + "]"), 1)
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))


def stats(cigar) -> Column:
    """The op-class sums every metric needs, each computed once: ``mx`` (M,=,X), ``eq`` (=),
    ``i``, ``d``, ``n``, ``clip`` (S,H) and ``has_m``.  Compute it in one projection and derive
    identity / coverage / spans from it with plain arithmetic."""
    c = _c(cigar)
    return F.struct(op_sum(c, "M=X").alias("mx"), op_sum(c, "=").alias("eq"), op_sum(c, "I").alias("i"),
                    op_sum(c, "D").alias("d"), op_sum(c, "N").alias("n"), op_sum(c, "SH").alias("clip"),
                    c.rlike(r"\dM").alias("has_m"))


def identity_from(st: Column, nm) -> Column:
    cols = st["mx"] + st["i"] + st["d"]
    mism = _c(nm).cast("bigint") - st["i"] - st["d"]
    matches = F.when(st["has_m"], st["mx"] - mism).otherwise(st["eq"])
    return F.when(cols > 0, matches / cols)


def coverage_from(st: Column) -> Column:
    aligned = st["mx"] + st["i"]
    total = aligned + st["clip"]
    return F.when(total > 0, aligned / total)


def refspan_from(st: Column) -> Column:
    return st["mx"] + st["d"] + st["n"]


def qspan_from(st: Column, cigar) -> Column:
    return st["mx"] + st["i"] + op_sum(cigar, "S")


def has_op(cigar, op: str) -> Column:
    return _c(cigar).rlike(r"\d" + op)


def alignment_columns(cigar) -> Column:
    return op_sum(cigar, "M=XID")


def seq_identity(cigar, nm) -> Column:
    """BLAST-style identity; null when the alignment has no columns (e.g. ``*``)."""
    cols = op_sum(cigar, "M=XID")
    mism = _c(nm).cast("bigint") - op_sum(cigar, "ID")
    matches = F.when(has_op(cigar, "M"), op_sum(cigar, "M=X") - mism).otherwise(op_sum(cigar, "="))
    return F.when(cols > 0, matches / cols)


def query_coverage(cigar) -> Column:
    aligned = op_sum(cigar, "M=XI")
    total = op_sum(cigar, "M=XISH")
    return F.when(total > 0, aligned / total)


def reference_span(cigar) -> Column:
    return op_sum(cigar, "M=XDN")


def query_span(cigar) -> Column:
    return op_sum(cigar, "M=XIS")


def with_alignment_coords(aln, pos_col: str = "pos", cigar_col: str = "cigar"):
    """SAM POS is 1-based: ``start = pos - 1``, ``stop = start + reference span`` (half-open)."""
    return (aln.withColumn("start", F.col(pos_col) - 1)
               .withColumn("stop", F.col("start") + reference_span(cigar_col)))


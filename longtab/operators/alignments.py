"""Alignment filters and enrichment (FLT1-FLT4, REL5, SAM text export).

Alignments are the M5 table: ``sample_id, read_id, flag, ref_id, pos, mapq, cigar, tag_nm,
tag_md`` (+ optional ``seq``, ``qual``).  Everything here is a narrow, codegen-friendly
projection or filter; nothing shuffles except the length join, which broadcasts the
reference-length table only after its size is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C

SAM_FIELDS = ("read_id", "flag", "ref_id", "pos", "mapq", "cigar")

# SAM flag bits used by the filters.
FLAG_UNMAPPED = 0x4
FLAG_SECONDARY = 0x100
FLAG_SUPPLEMENTARY = 0x800


def fraction(x: float) -> float:
    """Thresholds arrive as fractions (0.95) or percents (95, 99.9): values >= 1 are percents."""
    x = float(x)
    # rounded so that 99.9 gives exactly 0.999 (99.9 / 100 is 0.9990000000000001)
    return round(x / 100.0, 12) if x >= 1.0 else x


def fraction_col(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c >= 1, c / 100).otherwise(c)


def slim(aln: DataFrame) -> DataFrame:
    """FLT1: drop header rows and the SEQ/QUAL payload (kept out of the alignment table)."""
    out = aln.filter(~F.col("read_id").startswith("@"))
    return out.drop(*[c for c in ("seq", "qual") if c in aln.columns])


def flag_filter(aln: DataFrame, mapped: bool = True, primary: bool = True,
                no_supplementary: bool = True) -> DataFrame:
    """FLT2: ``-F 4``, ``--secondary=no``, ``-F 0x800`` as bit tests."""
    mask = ((FLAG_UNMAPPED if mapped else 0) | (FLAG_SECONDARY if primary else 0)
            | (FLAG_SUPPLEMENTARY if no_supplementary else 0))
    return aln.filter(F.col("flag").bitwiseAND(F.lit(mask)) == 0) if mask else aln


_STATS = ("mx", "eq", "i", "d", "n", "clip", "has_m")


def with_cigar_stats(aln: DataFrame) -> DataFrame:
    """Adds the CIGAR op-class sums as columns, each computed once per row.

    They are produced by ``inline`` of a one-element array (a Generate node): predicates on the
    sums cannot be pushed below it, so a filter that uses a sum several times does not re-run
    the regex passes (pushing a filter through a plain projection would inline them)."""
    return aln.select("*", F.inline(F.array(C.stats("cigar"))))


def with_metrics(aln: DataFrame) -> DataFrame:
    """Adds ``identity`` and ``query_coverage`` from one parse of the CIGAR."""
    cols = aln.columns
    s = with_cigar_stats(aln)
    st = F.struct(*[F.col(c) for c in _STATS])
    return s.select(*cols, C.identity_from(st, "tag_nm").alias("identity"),
                    C.coverage_from(st).alias("query_coverage"))


def _metric_filter(aln: DataFrame, cond) -> DataFrame:
    cols = aln.columns
    s = with_cigar_stats(aln)
    st = F.struct(*[F.col(c) for c in _STATS])
    return s.filter(cond(C.identity_from(st, "tag_nm"), C.coverage_from(st))).select(*cols)


def identity_coverage_filter(aln: DataFrame, identity: float = 0.9,
                             coverage: float = 0.9) -> DataFrame:
    """FLT3, the profile query: keep identity > p AND query coverage > c (both strict)."""
    return _metric_filter(aln, lambda i, c: (i > F.lit(float(identity))) & (c > F.lit(float(coverage))))


def min_filter(aln: DataFrame, min_identity: float, min_aligned: float = 0.0) -> DataFrame:
    """FLT4: read identity >= p and aligned fraction >= a; percents or fractions accepted."""
    p, a = fraction(min_identity), fraction(min_aligned)
    return _metric_filter(aln, lambda i, c: (i >= F.lit(p)) & (c >= F.lit(a)))


def attach_lengths(aln: DataFrame, lengths: DataFrame, how: str = "inner") -> DataFrame:
    """REL5: reference length per alignment (the SAM header is stripped, so it comes from a table)."""
    return aln.join(lengths.select("ref_id", "length"), "ref_id", how)


def sam_text(aln: DataFrame) -> DataFrame:
    """SAM body lines with SEQ and QUAL blanked to ``*`` (the slimmed export)."""
    nine = [F.col(c).cast("string") for c in SAM_FIELDS]
    rest = [F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"),
            F.concat(F.lit("NM:i:"), F.col("tag_nm").cast("string"))]
    if "tag_md" in aln.columns:
        rest.append(F.concat(F.lit("MD:Z:"), F.col("tag_md")))     # a null tag is left out
    return aln.select("sample_id", F.concat_ws("\t", *nine, *rest).alias("line"))

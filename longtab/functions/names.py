"""Name and small scalar functions as Column expressions (FN4-FN9, FN11, FN12)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Compression extensions stripped before the real extension.
COMPRESSION_EXTS = (".gz", ".bz2", ".xz", ".lz")
NCBI_PATTERN = r"^GC[FA]_([0-9]{9})\.[0-9]+_.*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def strip_suffix(s, suffix: str) -> Column:
    s = _c(s)
    return F.when(s.endswith(suffix), F.substring(s, F.lit(1), F.length(s) - len(suffix))).otherwise(s)


def replace_first(s, literal: str, repl: str = "") -> Column:
    """Replace the first occurrence of a literal (what ``${x/pat/}`` does)."""
    s = _c(s)
    pos = F.locate(literal, s)
    return F.when(pos > 0, F.concat(F.substring(s, F.lit(1), pos - 1), F.lit(repl),
                                    F.substring(s, pos + len(literal), F.lit(1 << 30)))).otherwise(s)


def before_first(s, sep: str = "_") -> Column:
    """Text before the first ``sep`` (the artifact id of a pooled file name)."""
    return F.substring_index(_c(s), sep, 1)


def split_ext(s) -> tuple[Column, Column]:
    """``os.path.splitext`` on a basename: (root, ext) at the last dot (a leading dot is not an ext)."""
    s = _c(s)
    ext = F.regexp_extract(s, r"^(.*[^.].*)(\.[^.]*)$", 2)
    root = F.substring(s, F.lit(1), F.length(s) - F.length(ext))
    return root, ext


def genome_stem(fname) -> Column:
    """Genome id from a file name: drop the extension, and one more when the first was a
    compression extension."""
    root, ext = split_ext(fname)
    root2, _ = split_ext(root)
    return F.when((F.length(ext) > 1) & ext.isin(*COMPRESSION_EXTS), root2).otherwise(root)


def ncbi_id(stem) -> Column:
    """FN9: ``GCF_123456789.1_xxx`` -> ``G123456789``; other names unchanged."""
    s = _c(stem)
    return F.when(s.rlike(NCBI_PATTERN), F.concat(F.lit("G"), F.regexp_extract(s, NCBI_PATTERN, 1))).otherwise(s)


def expand_gap(spec) -> Column:
    """FN8: ``N*20`` -> 20 N (split at the last ``*``; the count must be all digits)."""
    s = _c(spec)
    pat = r"^(.*)\*([0-9]+)$"
    return F.when(s.rlike(pat), F.repeat(F.regexp_extract(s, pat, 1),
                                          F.regexp_extract(s, pat, 2).cast("int"))).otherwise(s)


def sig6(x) -> Column:
    """FN7: value printed with 6 significant digits as C ``printf('%.6g')`` does, read back as
    a double.  C rounds the exact binary value; Java's formatter rounds the shortest decimal
    form, so the two differ on apparent ties — hence a small Arrow-batched helper.  It is
    only used on export columns."""
    return _sig6_udf(_c(x).cast("double"))


@F.pandas_udf(T.DoubleType())
def _sig6_udf(v: pd.Series) -> pd.Series:
    return v.map(lambda a: float("%.6g" % a) if a == a else a)


def revcomp(seq) -> Column:
    """FN11: reverse complement of an A/C/G/T(/N) sequence."""
    return F.reverse(F.translate(_c(seq), "ACGTacgt", "TGCAtgca"))


def to_bool(x) -> Column:
    """FN12: ``True`` or ``"True"`` (any case) is true."""
    return F.lower(_c(x).cast("string")) == "true"


def strip_thousands(x) -> Column:
    return F.regexp_replace(_c(x), ",", "")

"""Registered queries: one Spark plan per operator and, where SQL can say it, an
independent DuckDB oracle over the same domain views.

Each Spark plan reads the driver's tables through ``views.view`` (so its work grows with
them) and applies our DataFrame operators; each oracle is hand-written SQL.  Column names and
types agree between the two sides.  Doubles that come from sums are rounded to 6 places on
both sides (summation order differs between engines); exact ratios are left exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sqlfrag as Q
from . import views as V
from ..functions import cigar as C
from ..operators import alignments as A
from ..operators import coverage as COV
from ..operators import intervals as IV
from ..operators import profile as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def oracle_text(key: str) -> str:
    """Full DuckDB text: needed views as CTEs, then the query (which may add its own CTEs)."""
    sql = ORACLE[key].strip()
    views = V.used_views(sql)
    head = V.with_clause(views, "duckdb", lambda t: t)
    if not head:
        return sql
    if sql[:4].upper() == "WITH":
        return head.rstrip() + ",\n" + sql[4:].lstrip()
    return head + sql


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------------------------------------
# Parameters of the registered queries (operator defaults live in the operators).
PROFILE_IDENTITY = 0.9      # profile command default
PROFILE_COVERAGE = 0.9
REMAP_IDENTITY = 0.95       # remap-style minimum filter, as a fraction
REMAP_ALIGNED = 90          # given as a percent on purpose (normalised to 0.90)

_ID = Q.identity()
_QC = Q.qcov()
_FILTER = f"{_ID} > {PROFILE_IDENTITY} AND {_QC} > {PROFILE_COVERAGE}"
_MAPPED_PRIMARY = "(flag & 2308) = 0"


def _aln(spark, sf):
    return V.view(spark, sf, "v_align")


def _profile_alignments(spark, sf):
    return A.identity_coverage_filter(_aln(spark, sf), PROFILE_IDENTITY, PROFILE_COVERAGE)


def _remap_alignments(spark, sf):
    return A.min_filter(A.flag_filter(_aln(spark, sf)), REMAP_IDENTITY, REMAP_ALIGNED)


# --- FLT3 flagship -----------------------------------------------------------------------------
@register("aln_filter", f"SELECT * FROM v_align WHERE {_FILTER}")
def q_aln_filter(spark, sf):
    return _profile_alignments(spark, sf)


@register("genome_profile", f"""
WITH f AS (SELECT DISTINCT sample_id, read_id, ref_id FROM v_align WHERE {_FILTER} AND ref_id <> '*'),
k AS (SELECT sample_id, read_id, ref_id, count(*) OVER (PARTITION BY sample_id, read_id) AS k FROM f),
s AS (SELECT sample_id, ref_id AS feature_id, round(sum(1.0::double / k), 9) AS v FROM k GROUP BY sample_id, ref_id)
SELECT sample_id, feature_id, cast(round_even(v, 0) AS double) AS value FROM s WHERE round_even(v, 0) <> 0
""")
def q_genome_profile(spark, sf):
    return P.genome_profile(_profile_alignments(spark, sf))


# --- FLT1/FLT2/FLT4/REL5 -----------------------------------------------------------------------
@register("aln_slim", """
SELECT sample_id, read_id || chr(9) || cast(flag AS varchar) || chr(9) || ref_id || chr(9) || cast(pos AS varchar)
       || chr(9) || cast(mapq AS varchar) || chr(9) || cigar || chr(9) || '*' || chr(9) || '0' || chr(9) || '0'
       || chr(9) || '*' || chr(9) || '*' || chr(9) || 'NM:i:' || cast(tag_nm AS varchar)
       || chr(9) || 'MD:Z:' || tag_md AS line
FROM v_align WHERE NOT starts_with(read_id, '@')
""")
def q_aln_slim(spark, sf):
    return A.sam_text(A.slim(_aln(spark, sf)))


@register("aln_flags", f"SELECT sample_id, read_id, flag, ref_id, pos FROM v_align WHERE {_MAPPED_PRIMARY}")
def q_aln_flags(spark, sf):
    return A.flag_filter(_aln(spark, sf)).select("sample_id", "read_id", "flag", "ref_id", "pos")


@register("aln_min_filter", f"""
SELECT sample_id, read_id, ref_id, cigar, {_ID} AS identity, {_QC} AS query_coverage
FROM v_align WHERE {_MAPPED_PRIMARY} AND {_ID} >= 0.95 AND {_QC} >= 0.9
""")
def q_aln_min_filter(spark, sf):
    return (A.with_metrics(_remap_alignments(spark, sf))
            .select("sample_id", "read_id", "ref_id", "cigar", "identity", "query_coverage"))


@register("aln_lengths", f"""
SELECT a.sample_id, a.read_id, a.ref_id, a.pos, l.length
FROM v_align a JOIN v_lengths l ON a.ref_id = l.ref_id WHERE {_MAPPED_PRIMARY}
""")
def q_aln_lengths(spark, sf):
    aln = A.flag_filter(_aln(spark, sf))
    return A.attach_lengths(aln, V.view(spark, sf, "v_lengths")).select(
        "sample_id", "read_id", "ref_id", "pos", "length")


# --- FN1-FN3 -----------------------------------------------------------------------------------
@register("fn_identity", f"SELECT sample_id, read_id, ref_id, cigar, tag_nm, {_ID} AS identity FROM v_align")
def q_fn_identity(spark, sf):
    return _aln(spark, sf).select("sample_id", "read_id", "ref_id", "cigar", "tag_nm",
                                  C.seq_identity("cigar", "tag_nm").alias("identity"))


@register("fn_qcov", f"SELECT sample_id, read_id, ref_id, cigar, {_QC} AS query_coverage FROM v_align")
def q_fn_qcov(spark, sf):
    return _aln(spark, sf).select("sample_id", "read_id", "ref_id", "cigar",
                                  C.query_coverage("cigar").alias("query_coverage"))


@register("fn_refspan", f"""
SELECT sample_id, read_id, ref_id, cigar, pos - 1 AS start, pos - 1 + {Q.refspan()} AS stop,
       {Q.qspan()} AS query_span
FROM v_align WHERE ref_id <> '*'
""")
def q_fn_refspan(spark, sf):
    a = C.with_alignment_coords(_aln(spark, sf).filter(F.col("ref_id") != "*"))
    return a.select("sample_id", "read_id", "ref_id", "cigar", "start", "stop",
                    C.query_span("cigar").alias("query_span"))


# --- intervals / coverage (WIN1-3, AGG4-8) -----------------------------------------------------
_COORDS = f"(SELECT sample_id, read_id, ref_id, pos - 1 AS start, pos - 1 + {Q.refspan()} AS stop FROM v_align WHERE {_FILTER} AND ref_id <> '*')"
_REMAP = f"(SELECT sample_id, read_id, ref_id, cigar, pos - 1 AS start, pos - 1 + {Q.refspan()} AS stop FROM v_align WHERE {_MAPPED_PRIMARY} AND {_ID} >= 0.95 AND {_QC} >= 0.9)"


@register("cov_intervals", "SELECT * FROM " + Q.islands(_COORDS, "sample_id, ref_id") + " t")
def q_cov_intervals(spark, sf):
    return COV.covered_intervals(_profile_alignments(spark, sf))


@register("depth_runs", "SELECT * FROM " + Q.depth_runs(_REMAP, "sample_id, ref_id") + " t")
def q_depth_runs(spark, sf):
    a = C.with_alignment_coords(_remap_alignments(spark, sf))
    return IV.depth_runs(a, ["sample_id", "ref_id"])


_GENOME_DEPTH_SQL = f"""
WITH runs AS {Q.depth_runs(_REMAP, "sample_id, ref_id")},
st AS (SELECT sample_id, ref_id, sum(CASE WHEN depth > 0 THEN stop - start ELSE 0 END) AS covered_bases,
              sum((stop - start) * depth) AS depth_sum FROM runs GROUP BY sample_id, ref_id),
sl AS (SELECT st.*, l.length FROM st JOIN v_lengths l ON st.ref_id = l.ref_id),
hist AS (SELECT sample_id, ref_id, depth, sum(stop - start) AS w FROM runs WHERE depth > 0 GROUP BY sample_id, ref_id, depth
         UNION ALL SELECT sample_id, ref_id, 0 AS depth, length - covered_bases AS w FROM sl WHERE length - covered_bases > 0),
cum AS (SELECT h.sample_id, h.ref_id, h.depth, h.w, sl.length,
               sum(h.w) OVER (PARTITION BY h.sample_id, h.ref_id ORDER BY h.depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi_cum
        FROM hist h JOIN sl ON h.sample_id = sl.sample_id AND h.ref_id = sl.ref_id),
cut AS (SELECT *, hi_cum - w AS lo_cum, floor(length * 0.05) AS c_lo, length - floor(length * (1.0 - 0.95)) AS c_hi FROM cum),
tm AS (SELECT sample_id, ref_id,
              sum(greatest(0, least(hi_cum, c_hi) - greatest(lo_cum, c_lo)) * depth) AS s, max(c_hi - c_lo) AS n
       FROM cut GROUP BY sample_id, ref_id),
cnt AS (SELECT sample_id, ref_id, count(DISTINCT read_id) AS read_count FROM {_REMAP} r GROUP BY sample_id, ref_id)
"""


@register("trimmed_mean", _GENOME_DEPTH_SQL + """
SELECT sample_id, ref_id, round(CASE WHEN n > 0 THEN s / n ELSE 0.0 END, 6) AS trimmed_mean FROM tm
""")
def q_trimmed_mean(spark, sf):
    d = COV.genome_depth(_remap_alignments(spark, sf), V.view(spark, sf, "v_lengths"))
    return d.select("sample_id", F.col("genome_id").alias("ref_id"), r6("trimmed_mean").alias("trimmed_mean"))


@register("genome_depth", _GENOME_DEPTH_SQL + """
SELECT sl.sample_id, sl.ref_id AS genome_id, cast(sl.covered_bases AS bigint) AS covered_bases,
       round(CASE WHEN tm.n > 0 THEN tm.s / tm.n ELSE 0.0 END, 6) AS trimmed_mean,
       round(CASE WHEN sl.length > 0 THEN sl.depth_sum / sl.length ELSE 0.0 END, 6) AS mean,
       sl.length, cnt.read_count
FROM sl JOIN tm ON sl.sample_id = tm.sample_id AND sl.ref_id = tm.ref_id
        JOIN cnt ON sl.sample_id = cnt.sample_id AND sl.ref_id = cnt.ref_id
""")
def q_genome_depth(spark, sf):
    d = COV.genome_depth(_remap_alignments(spark, sf), V.view(spark, sf, "v_lengths"))
    return d.withColumn("trimmed_mean", r6("trimmed_mean")).withColumn("mean", r6("mean"))


@register("genome_cov_summary", _GENOME_DEPTH_SQL + """
SELECT sample_id, ref_id AS mag_id, cast(covered_bases AS bigint) AS covered, length,
       covered_bases / length AS percent_covered
FROM sl WHERE length > 0
""")
def q_genome_cov_summary(spark, sf):
    d = COV.genome_depth(_remap_alignments(spark, sf), V.view(spark, sf, "v_lengths"))
    return COV.coverage_summary(d)


@register("contig_depth", f"""
SELECT a.sample_id, a.ref_id AS contig_id, CASE WHEN l.length > 0 THEN a.b / l.length END AS mean, a.read_count
FROM (SELECT sample_id, ref_id, sum({Q.refspan()}) AS b, count(*) AS read_count
      FROM v_align WHERE ref_id <> '*' AND {_ID} >= 0.95 GROUP BY sample_id, ref_id) a
JOIN v_lengths l ON a.ref_id = l.ref_id
""")
def q_contig_depth(spark, sf):
    aln = A.min_filter(_aln(spark, sf), 0.95, 0.0)
    return COV.contig_depth(aln, V.view(spark, sf, "v_lengths"))


@register("coverage_consolidate", f"""
WITH iv AS {Q.islands(_COORDS, "sample_id, ref_id")},
pooled AS {Q.islands("iv", "ref_id")},
c AS (SELECT sample_id, ref_id, sum(stop - start) AS covered FROM iv GROUP BY sample_id, ref_id
      UNION ALL SELECT '*' AS sample_id, ref_id, sum(stop - start) AS covered FROM pooled GROUP BY ref_id)
SELECT c.sample_id, c.ref_id, cast(c.covered AS bigint) AS covered, l.length,
       CASE WHEN l.length > 0 THEN c.covered / l.length END AS fraction
FROM c JOIN v_lengths l ON c.ref_id = l.ref_id
""")
def q_coverage_consolidate(spark, sf):
    iv = COV.covered_intervals(_profile_alignments(spark, sf))
    return COV.consolidate(iv, V.view(spark, sf, "v_lengths"))


# --- REL6, AGG2, AGG3 --------------------------------------------------------------------------
_GENE_HITS_SQL = f"""
WITH a AS {_COORDS},
hits AS (SELECT a.sample_id, a.read_id, a.ref_id, g.gene_id, a.start, a.stop
         FROM a JOIN v_genes g ON a.ref_id = g.ref_id AND a.start < g.stop AND g.start < a.stop
         WHERE (least(a.stop, g.stop) - greatest(a.start, g.start)) * 100 >= 80 * (a.stop - a.start))
"""
_GENE_PROFILE_SQL = _GENE_HITS_SQL + """,
f AS (SELECT DISTINCT sample_id, read_id, gene_id FROM hits),
k AS (SELECT sample_id, gene_id, count(*) OVER (PARTITION BY sample_id, read_id) AS k FROM f),
s AS (SELECT sample_id, gene_id AS feature_id, round(sum(1.0::double / k), 9) AS v FROM k GROUP BY sample_id, gene_id),
gene AS (SELECT sample_id, feature_id, cast(round_even(v, 0) AS double) AS value FROM s WHERE round_even(v, 0) <> 0),
ko AS (SELECT t.sample_id, m.target AS feature_id, sum(t.value) AS value FROM gene t
       JOIN v_maps m ON m.map = 'ko' AND m.source = t.feature_id GROUP BY t.sample_id, m.target),
ec AS (SELECT t.sample_id, m.target AS feature_id, sum(t.value) AS value FROM ko t
       JOIN v_maps m ON m.map = 'ec' AND m.source = t.feature_id GROUP BY t.sample_id, m.target),
reaction AS (SELECT t.sample_id, m.target AS feature_id, sum(t.value) AS value FROM ko t
       JOIN v_maps m ON m.map = 'reaction' AND m.source = t.feature_id GROUP BY t.sample_id, m.target),
module AS (SELECT t.sample_id, m.target AS feature_id, sum(t.value) AS value FROM reaction t
       JOIN v_maps m ON m.map = 'module' AND m.source = t.feature_id GROUP BY t.sample_id, m.target),
pathway AS (SELECT t.sample_id, m.target AS feature_id, sum(t.value) AS value FROM module t
       JOIN v_maps m ON m.map = 'pathway' AND m.source = t.feature_id GROUP BY t.sample_id, m.target)
"""


def _gene_hits(spark, sf):
    a = C.with_alignment_coords(_profile_alignments(spark, sf).filter(F.col("ref_id") != "*"))
    return P.read_gene_hits(a, V.view(spark, sf, "v_genes"))


def _functional(spark, sf):
    gene = P.split_counts(_gene_hits(spark, sf), "gene_id")
    return P.functional_tables(gene, V.view(spark, sf, "v_maps"))


@register("gene_overlap", _GENE_HITS_SQL + "SELECT * FROM hits")
def q_gene_overlap(spark, sf):
    return _gene_hits(spark, sf).select("sample_id", "read_id", "ref_id", "gene_id", "start", "stop")


@register("gene_profile", _GENE_PROFILE_SQL + "SELECT * FROM gene")
def q_gene_profile(spark, sf):
    return _functional(spark, sf)["gene"]


for _rank in ("ko", "ec", "reaction", "module", "pathway"):
    def _mk(rank):
        def q(spark, sf):
            return _functional(spark, sf)[rank]
        q.__name__ = f"q_collapse_{rank}"
        return q
    register(f"collapse_{_rank}", _GENE_PROFILE_SQL + f"SELECT * FROM {_rank}")(_mk(_rank))


# --- feature tables (SET1, SET6, REL8, SRC12, SRC13, FLT11) ------------------------------------
from ..operators import audit as AU  # noqa: E402
from ..operators import features as FT  # noqa: E402
from ..operators import lookup as LK  # noqa: E402

_MERGED = "(SELECT sample_id, feature_id, sum(value) AS value FROM v_tables GROUP BY sample_id, feature_id HAVING sum(value) <> 0)"
_TIP_LABEL = ("replace(CASE WHEN starts_with(t, '''') THEN replace(substr(t, 2, length(t) - 2), '''''', '''') "
              "ELSE t END, ' ', '_')")
_TIP_RE = FT.TIP_PATTERN.replace("'", "''")
_TIPS = (f"(SELECT DISTINCT {_TIP_LABEL} AS tip FROM (SELECT unnest(regexp_extract_all(newick, '{_TIP_RE}', 2)) AS t "
         f"FROM v_tree) x WHERE t <> '' AND {_TIP_LABEL} <> '')")


def _merged(spark, sf):
    return FT.merge_tables(V.view(spark, sf, "v_tables"))


def _tips(spark, sf):
    return FT.tree_tips(V.view(spark, sf, "v_tree"))


@register("feature_merge", "SELECT * FROM " + _MERGED + " m")
def q_feature_merge(spark, sf):
    return _merged(spark, sf)


@register("feature_dups", """
WITH t AS (SELECT table_id, sample_id FROM v_tables
           UNION ALL SELECT 'syn' AS table_id, sample_id FROM v_syndna)
SELECT sample_id, count(DISTINCT table_id) AS n_tables FROM t GROUP BY sample_id HAVING count(DISTINCT table_id) > 1
""")
def q_feature_dups(spark, sf):
    syn = V.view(spark, sf, "v_syndna").select(F.lit("syn").alias("table_id"), "sample_id")
    t = V.view(spark, sf, "v_tables").select("table_id", "sample_id").unionByName(syn)
    return FT.duplicate_samples(t).select("sample_id", "n_tables")


@register("tree_tips", "SELECT * FROM " + _TIPS + " t")
def q_tree_tips(spark, sf):
    return _tips(spark, sf)


@register("tree_filter", f"SELECT m.* FROM {_MERGED} m WHERE feature_id IN (SELECT tip FROM {_TIPS} t)")
def q_tree_filter(spark, sf):
    return FT.tree_filter(_merged(spark, sf), _tips(spark, sf))


@register("tree_removed", f"SELECT DISTINCT feature_id FROM {_MERGED} m WHERE feature_id NOT IN (SELECT tip FROM {_TIPS} t)")
def q_tree_removed(spark, sf):
    return FT.tree_removed(_merged(spark, sf), _tips(spark, sf))


_SAMPLES = [f"S{i}" for i in range(8)]        # the sample ids that the alignment views are built with


@register("feature_pivot", "SELECT feature_id, " + ", ".join(
    f"sum(value) FILTER (WHERE sample_id = '{s}') AS \"{s}\"" for s in _SAMPLES) + f" FROM {_MERGED} m GROUP BY feature_id")
def q_feature_pivot(spark, sf):
    return FT.to_wide(_merged(spark, sf), _SAMPLES)


@register("empty_samples", """
WITH man AS (SELECT DISTINCT sample_id FROM v_reads),
c AS (SELECT sample_id, count(*) AS n FROM v_read_hits WHERE ref_id = 'plasmid' AND (flag & 4) = 0 GROUP BY sample_id)
SELECT man.sample_id, cast(coalesce(c.n, 0) AS bigint) AS total,
       CASE WHEN coalesce(c.n, 0) = 0 THEN 'empty' ELSE 'ok' END AS state
FROM man LEFT JOIN c ON man.sample_id = c.sample_id
""")
def q_empty_samples(spark, sf):
    hits = (A.flag_filter(V.view(spark, sf, "v_read_hits"), primary=False, no_supplementary=False)
            .filter(F.col("ref_id") == "plasmid").withColumn("value", F.lit(1)))
    return FT.sample_totals(V.view(spark, sf, "v_reads"), hits)


# --- REL1, REL11 -------------------------------------------------------------------------------
_LOOKUP_SQL = """
WITH lk AS (SELECT run_prefix, max_by(sample_name, ord) AS sample_id, min(ord) AS ord FROM v_prep GROUP BY run_prefix),
pos AS (SELECT file_no, file_name, unnest(range(1, length(file_name) + 1)) AS i FROM v_files),
c AS (SELECT file_no, file_name, 0 AS tier, file_name AS pre, 0 AS rk FROM v_files
      UNION ALL SELECT file_no, file_name, 1, substr(file_name, 1, i - 1), 1 - i FROM pos WHERE substr(file_name, i, 1) = '_'
      UNION ALL SELECT file_no, file_name, 2, substr(file_name, 1, i - 1), 1 - i FROM pos WHERE substr(file_name, i, 1) = '.'
      UNION ALL SELECT file_no, file_name, 3, substr(file_name, 1, i), 0 FROM pos),
h AS (SELECT c.file_no, lk.sample_id, c.tier,
             row_number() OVER (PARTITION BY c.file_no ORDER BY c.tier, CASE WHEN c.tier = 3 THEN lk.ord ELSE c.rk END) AS rn
      FROM c JOIN lk ON c.pre = lk.run_prefix),
m AS (SELECT f.file_no, f.file_name, h.sample_id, h.tier FROM v_files f LEFT JOIN h ON f.file_no = h.file_no AND h.rn = 1)
"""


def _matched(spark, sf):
    lk = LK.build_lookup(V.view(spark, sf, "v_prep"))
    return LK.match_files(V.view(spark, sf, "v_files"), lk)


@register("sample_lookup", _LOOKUP_SQL + "SELECT * FROM m")
def q_sample_lookup(spark, sf):
    return _matched(spark, sf).select("file_no", "file_name", "sample_id", "tier")


_EXPAND_SQL = """
WITH pair AS (SELECT r.artifact_id, t.parent_id FROM v_artifacts r LEFT JOIN v_artifact_tree t ON t.artifact_id = r.artifact_id),
f AS (SELECT DISTINCT artifact_id AS parent_id, path, regexp_replace(path, '.*/', '') AS name FROM v_artifact_files WHERE kind = 'fwd'),
lk AS (SELECT artifact_id AS parent_id, run_prefix, arg_max(sample_name, ord) AS sample_id, min(ord) AS ord
       FROM v_artifact_preps GROUP BY artifact_id, run_prefix),
h AS (SELECT f.parent_id, f.path, lk.sample_id, row_number() OVER (PARTITION BY f.parent_id, f.path ORDER BY
        CASE WHEN f.name = lk.run_prefix THEN 0 WHEN substr(f.name, length(lk.run_prefix) + 1, 1) = '_' THEN 1
             WHEN substr(f.name, length(lk.run_prefix) + 1, 1) = '.' THEN 2 ELSE 3 END,
        CASE WHEN substr(f.name, length(lk.run_prefix) + 1, 1) IN ('_', '.') THEN -length(lk.run_prefix) ELSE lk.ord END) AS rn
      FROM f JOIN lk ON lk.parent_id = f.parent_id AND starts_with(f.name, lk.run_prefix)),
x AS (SELECT p.artifact_id, p.parent_id, h.sample_id, f.path,
        CASE WHEN p.parent_id IS NULL THEN 'no parents' WHEN f.path IS NULL THEN 'no files'
             WHEN p.parent_id NOT IN (SELECT parent_id FROM lk) THEN 'no preparation' WHEN h.sample_id IS NULL THEN 'no sample' END AS reason
      FROM pair p LEFT JOIN f ON f.parent_id = p.parent_id LEFT JOIN h ON h.parent_id = f.parent_id AND h.path = f.path AND h.rn = 1)
"""


def _expanded(spark, sf):
    return LK.expand_artifacts(*[V.view(spark, sf, v) for v in ("v_artifacts", "v_artifact_tree", "v_artifact_files", "v_artifact_preps")])


@register("analysis_manifest", _EXPAND_SQL + "SELECT artifact_id, parent_id, sample_id, path FROM x WHERE reason IS NULL")
def q_analysis_manifest(spark, sf):
    return _expanded(spark, sf)[0]


@register("analysis_errors", _EXPAND_SQL + "SELECT artifact_id, parent_id, path, reason FROM x WHERE reason IS NOT NULL")
def q_analysis_errors(spark, sf):
    return _expanded(spark, sf)[1]


# --- REL10, AGG16 ------------------------------------------------------------------------------
_STEPS_SQL = """
WITH ex AS (SELECT DISTINCT job_id, task FROM v_status),
pj AS (SELECT job_id, count(*) AS expected FROM ex GROUP BY job_id),
grid AS (SELECT job_id, expected, cast(unnest(range(1, 8)) AS bigint) AS step FROM pj),
cnt AS (SELECT job_id, cast(step AS bigint) AS step,
               count(DISTINCT CASE WHEN state IN ('completed', 'skipped') THEN task END) AS done,
               count(DISTINCT CASE WHEN state = 'failed' THEN task END) AS failed
        FROM v_status GROUP BY job_id, step),
steps AS (SELECT g.job_id, g.step, g.expected, coalesce(c.done, 0) AS done, coalesce(c.failed, 0) AS failed,
                 g.expected - coalesce(c.done, 0) AS missing
          FROM grid g LEFT JOIN cnt c ON g.job_id = c.job_id AND g.step = c.step)
"""


def _steps(spark, sf):
    st = V.view(spark, sf, "v_status")
    return AU.step_audit(st, st.select("job_id", "task"), 7)


@register("audit_steps", _STEPS_SQL + "SELECT * FROM steps")
def q_audit_steps(spark, sf):
    return _steps(spark, sf)


@register("audit_outputs", _STEPS_SQL + """
SELECT job_id, cast(sum(failed) AS bigint) AS n_failed, cast(sum(missing) AS bigint) AS n_missing,
       sum(failed) = 0 AND sum(missing) = 0 AS ok
FROM steps GROUP BY job_id
""")
def q_audit_outputs(spark, sf):
    return AU.job_verdict(_steps(spark, sf))


@register("audit_failures", "SELECT job_id, step, task, sample_id, message FROM v_status WHERE state = 'failed'")
def q_audit_failures(spark, sf):
    return AU.failures(V.view(spark, sf, "v_status"))


@register("audit_syndna", """
WITH t AS (SELECT sample_id, sum(read_count) AS n FROM v_syndna GROUP BY sample_id)
SELECT m.sample_id, cast(coalesce(t.n, 0) AS bigint) AS total,
       CASE WHEN coalesce(t.n, 0) = 0 THEN 'empty' ELSE 'ok' END AS state
FROM v_manifest m LEFT JOIN t ON m.sample_id = t.sample_id
""")
def q_audit_syndna(spark, sf):
    return FT.sample_totals(V.view(spark, sf, "v_manifest"), V.view(spark, sf, "v_syndna"), "read_count")


# --- assembly post-processing (PIPE4) ----------------------------------------------------------
from ..functions import names as NM  # noqa: E402
from ..operators import contigs as CT  # noqa: E402
from ..operators import quality as QL  # noqa: E402

SMALL_KIB = 8             # size split threshold used on the document-sized contigs
GATE_BYTES = 150000       # binning gate used on the document-sized samples

_SEG = "(SELECT sample_id, contig_id, seq FROM v_gfa WHERE rec_type = 'S')"
_FB = "(strlen(contig_id) + 2 + length(seq) + ceil(length(seq) / 60))"
_LCG = f"(SELECT sample_id, contig_id, seq, CASE WHEN ceil({_FB} / 1024) < {SMALL_KIB} THEN 'small_LCG' ELSE 'LCG' END AS kind FROM {_SEG} s WHERE regexp_matches(contig_id, '.c$'))"
_NOLCG = f"(SELECT s.sample_id, s.contig_id, s.seq, 'noLCG' AS kind FROM {_SEG} s WHERE NOT EXISTS (SELECT 1 FROM {_LCG} l WHERE l.kind = 'LCG' AND l.sample_id = s.sample_id AND l.contig_id = s.contig_id))"
_C2B = f"""(SELECT b.* FROM v_bins b WHERE NOT ((binner = 'MetaBAT' AND bin_id IN ('bin.unbinned', 'bin.lowDepth', 'bin.tooShort', 'bin.BinInfo'))
                                        OR (binner = 'CONCOCT' AND bin_id IN ('unbinned')))
            AND EXISTS (SELECT 1 FROM {_NOLCG} n WHERE n.sample_id = b.sample_id AND n.contig_id = b.contig_id))"""
_BEST = f"""(SELECT sample_id, contig_id, binner, bin_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_id, contig_id ORDER BY score DESC, binner, bin_id) AS rn
  FROM {_C2B} c WHERE score > 0.5) r WHERE rn = 1)"""


def _segments(spark, sf):
    return CT.segments(V.view(spark, sf, "v_gfa"))


def _lcg(spark, sf):
    return CT.split_circular(_segments(spark, sf), SMALL_KIB)


def _nolcg(spark, sf):
    return CT.non_circular(_segments(spark, sf), _lcg(spark, sf))


def _best(spark, sf):
    return CT.best_bin(CT.contig_bins(V.view(spark, sf, "v_bins"), _nolcg(spark, sf)))


@register("circular_contigs", f"SELECT sample_id, contig_id, length(seq) AS length FROM {_SEG} s WHERE regexp_matches(contig_id, '.c$')")
def q_circular_contigs(spark, sf):
    s = _segments(spark, sf)
    return s.filter(CT.is_circular("contig_id")).select("sample_id", "contig_id", F.length("seq").alias("length"))


@register("lcg_size_split", f"SELECT sample_id, contig_id, kind FROM {_LCG} l")
def q_lcg_size_split(spark, sf):
    return _lcg(spark, sf).select("sample_id", "contig_id", "kind")


@register("nolcg_contigs", f"SELECT sample_id, contig_id, kind FROM {_NOLCG} n")
def q_nolcg_contigs(spark, sf):
    return _nolcg(spark, sf).select("sample_id", "contig_id", "kind")


@register("binning_gate", f"""
WITH haslcg AS (SELECT DISTINCT sample_id FROM {_LCG} l WHERE kind = 'LCG'),
per AS (SELECT n.sample_id, count(*) AS n_contigs,
               sum(CASE WHEN h.sample_id IS NULL THEN strlen(n.contig_id) + 2 + length(n.seq) + 1
                        ELSE strlen(n.contig_id) + 2 + length(n.seq) + ceil(length(n.seq) / 60) END) AS b
        FROM {_NOLCG} n LEFT JOIN haslcg h ON n.sample_id = h.sample_id GROUP BY n.sample_id)
SELECT sample_id, n_contigs, cast(b AS bigint) AS nolcg_bytes, b > {GATE_BYTES} AS passed FROM per
""")
def q_binning_gate(spark, sf):
    return CT.binning_gate(_nolcg(spark, sf), _lcg(spark, sf), GATE_BYTES)


@register("contig_min_len", f"SELECT sample_id, contig_id, length(seq) AS length FROM {_SEG} s WHERE length(seq) >= 16000")
def q_contig_min_len(spark, sf):
    return CT.min_length(_segments(spark, sf)).select("sample_id", "contig_id", F.length("seq").alias("length"))


@register("bin_exclude", """
SELECT * FROM v_bins WHERE NOT ((binner = 'MetaBAT' AND bin_id IN ('bin.unbinned', 'bin.lowDepth', 'bin.tooShort', 'bin.BinInfo'))
                               OR (binner = 'CONCOCT' AND bin_id IN ('unbinned')))
""")
def q_bin_exclude(spark, sf):
    return CT.drop_pseudo_bins(V.view(spark, sf, "v_bins"))


@register("contig2bin", f"SELECT sample_id, binner, contig_id, bin_id FROM {_C2B} c")
def q_contig2bin(spark, sf):
    return CT.contig_bins(V.view(spark, sf, "v_bins"), _nolcg(spark, sf)).select(
        "sample_id", "binner", "contig_id", "bin_id")


@register("contig2bin_files", f"SELECT sample_id, binner, contig_id, bin_id FROM {_C2B} c")
def q_contig2bin_files(spark, sf):
    """REL13 from the binners' files: written as each binner has them, read back by the column rule."""
    path = _scratch(spark, "contig2bin")
    CT.write_binner_files(V.view(spark, sf, "v_bins"), path)
    return CT.contig_bins(CT.read_binner_files(spark, path), _nolcg(spark, sf)).select("sample_id", "binner", "contig_id", "bin_id")


@register("best_bin", f"SELECT * FROM {_BEST} b")
def q_best_bin(spark, sf):
    return _best(spark, sf)


@register("genome_names", f"""
SELECT sample_id, sample_id || '_' || binner || '_' || bin_id AS genome_id, contig_id, 'MAG' AS kind FROM {_BEST} b
UNION ALL
SELECT sample_id, sample_id || '.' || contig_id AS genome_id, contig_id, kind FROM {_LCG} l
""")
def q_genome_names(spark, sf):
    return CT.mag_names(_best(spark, sf)).unionByName(CT.lcg_names(_lcg(spark, sf)))


@register("genome_pool", f"""
SELECT DISTINCT sample_id, genome_id, kind FROM (
  SELECT sample_id, sample_id || '_' || binner || '_' || bin_id AS genome_id, 'MAG' AS kind FROM {_BEST} b
  UNION ALL SELECT sample_id, sample_id || '.' || contig_id, kind FROM {_LCG} l WHERE kind = 'LCG') p
""")
def q_genome_pool(spark, sf):
    mags = CT.mag_names(_best(spark, sf)).select("sample_id", "genome_id", "kind")
    lcgs = CT.lcg_names(_lcg(spark, sf)).filter(F.col("kind") == "LCG").select("sample_id", "genome_id", "kind")
    return QL.pool_genomes(mags, lcgs).distinct()


# --- quality, N50, score (SET2, FLT10, WIN4, AGG9, AGG14) --------------------------------------
_N50 = """(SELECT genome_id, max(len) AS n50 FROM (
  SELECT genome_id, len, sum(len) OVER (PARTITION BY genome_id ORDER BY len DESC, contig_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum(len) OVER (PARTITION BY genome_id) AS tot
  FROM (SELECT genome_id, contig_id, cast(length(seq) AS bigint) AS len FROM v_contigs) c) w
WHERE 2 * cum >= tot GROUP BY genome_id)"""


@register("quality_merge", """
SELECT cast(artifact_id AS varchar) || '_' || bin_id AS genome_id, completeness, contamination, strain_heterogeneity FROM v_quality
""")
def q_quality_merge(spark, sf):
    return QL.merge_quality(V.view(spark, sf, "v_quality")).select(
        "genome_id", "completeness", "contamination", "strain_heterogeneity")


@register("genome_quality_gate", """
SELECT cast(artifact_id AS varchar) || '_' || bin_id AS genome_id, completeness, contamination FROM v_quality
WHERE completeness >= 50 AND contamination <= 10
""")
def q_genome_quality_gate(spark, sf):
    return QL.quality_gate(QL.merge_quality(V.view(spark, sf, "v_quality"))).select(
        "genome_id", "completeness", "contamination")


@register("n50", "SELECT * FROM " + _N50 + " n")
def q_n50(spark, sf):
    return QL.n50(V.view(spark, sf, "v_contigs"))


@register("genome_lengths", "SELECT genome_id, cast(sum(length(seq)) AS bigint) AS length FROM v_contigs GROUP BY genome_id")
def q_genome_lengths(spark, sf):
    return QL.genome_lengths(V.view(spark, sf, "v_contigs"))


@register("genome_score", f"""
SELECT q.bin_id AS genome_id, n.n50,
       round(CASE WHEN n.n50 > 0 THEN q.completeness - 5.0 * q.contamination + 1.0 * q.contamination * q.strain_heterogeneity / 100.0
                                      + 0.5 * log10(n.n50) END, 6) AS score
FROM v_quality q JOIN {_N50} n ON q.bin_id = n.genome_id
""")
def q_genome_score(spark, sf):
    q = V.view(spark, sf, "v_quality").withColumnRenamed("bin_id", "genome_id")
    s = QL.genome_score(q, QL.n50(V.view(spark, sf, "v_contigs")))
    return s.select("genome_id", "n50", r6("score").alias("score"))


# --- genome concatenation (PIPE6: REL9, FLT12, AGG11, AGG12) -----------------------------------
@register("genome_id_map", """
SELECT f.file_name, split_part(trim(f.file_name), '.fna', 1) AS file_stem, m.genome_id
FROM v_genome_files f LEFT JOIN v_genome_meta m ON split_part(trim(f.file_name), '.fna', 1) = m.file_stem
""")
def q_genome_id_map(spark, sf):
    files = V.view(spark, sf, "v_genome_files")
    return QL.map_genome_ids(files, V.view(spark, sf, "v_genome_meta")).select("file_name", "file_stem", "genome_id")


@register("genome_id_dups", """
SELECT m.genome_id, count(*) AS n_files
FROM v_genome_files f JOIN v_genome_meta m ON split_part(trim(f.file_name), '.fna', 1) = m.file_stem
GROUP BY m.genome_id HAVING count(*) > 1
""")
def q_genome_id_dups(spark, sf):
    files = V.view(spark, sf, "v_genome_files")
    return QL.duplicate_genomes(QL.map_genome_ids(files, V.view(spark, sf, "v_genome_meta")))


@register("title_filter", "SELECT rec_no, title FROM v_titles WHERE NOT regexp_matches(title, '[^a-zA-Z0-9](ring|bolt)[^a-zA-Z0-9]')")
def q_title_filter(spark, sf):
    return QL.title_filter(V.view(spark, sf, "v_titles"), "ring,bolt")


@register("genome_concat", """
SELECT genome_id, string_agg(seq, repeat('N', 20) ORDER BY ord) AS seq FROM v_contigs WHERE length(seq) > 0 GROUP BY genome_id
""")
def q_genome_concat(spark, sf):
    return QL.concat_genomes(V.view(spark, sf, "v_contigs"))


@register("genome_chunks", f"""
WITH whole AS (SELECT genome_id, string_agg(seq, repeat('N', 20) ORDER BY ord) AS s FROM v_contigs WHERE length(seq) > 0 GROUP BY genome_id)
SELECT genome_id, c AS chunk_no, substr(s, c * {QL.CHUNK} + 1, {QL.CHUNK}) AS seq
FROM (SELECT genome_id, s, unnest(range(0, (length(s) - 1) // {QL.CHUNK} + 1)) AS c FROM whole) x
""")
def q_genome_chunks(spark, sf):
    return QL.genome_chunks(V.view(spark, sf, "v_contigs"))


@register("genome_records", """
SELECT genome_id, ord, contig_id AS title, c AS chunk_no, substr(seq, c * 1024 + 1, 1024) AS seq
FROM (SELECT genome_id, ord, contig_id, seq, unnest(range(0, greatest(length(seq) - 1, 0) // 1024 + 1)) AS c FROM v_contigs) x
""")
def q_genome_records(spark, sf):
    return QL.record_chunks(V.view(spark, sf, "v_contigs"), chunk=1024, title_col="contig_id")


@register("genome_concat_stats", """
SELECT count(DISTINCT genome_id) AS genomes, count(*) AS sequences, cast(sum(length(seq)) AS bigint) AS characters
FROM v_contigs WHERE length(seq) > 0
""")
def q_genome_concat_stats(spark, sf):
    return QL.concat_stats(V.view(spark, sf, "v_contigs"))


# --- scalar functions (FN4-FN11) ---------------------------------------------------------------
@register("fn_names", """
SELECT file_no, 'runs/x/' || file_name AS path, file_name AS basename, split_part(file_name, '_', 1) AS aid,
       CASE WHEN ends_with(file_name, '.gz') THEN substr(file_name, 1, length(file_name) - 3) ELSE file_name END AS no_gz,
       regexp_replace(file_name, '_', '.') AS first_us_to_dot
FROM v_files
""")
def q_fn_names(spark, sf):
    f = V.view(spark, sf, "v_files").withColumn("path", F.concat(F.lit("runs/x/"), "file_name"))
    return f.select("file_no", "path", NM.basename("path").alias("basename"),
                    NM.before_first("file_name", "_").alias("aid"),
                    NM.strip_suffix("file_name", ".gz").alias("no_gz"),
                    NM.replace_first("file_name", "_", ".").alias("first_us_to_dot"))


@register("fn_fraction", "SELECT event_id, value, CASE WHEN value >= 1 THEN value / 100 ELSE value END AS fraction FROM events")
def q_fn_fraction(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", "value", A.fraction_col("value").alias("fraction"))


@register("fn_sig6", "SELECT l_orderkey, l_linenumber, cast(printf('%.6g', l_extendedprice / 7.0) AS double) AS v FROM lineitem")
def q_fn_sig6(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", NM.sig6(F.col("l_extendedprice") / 7.0).alias("v"))


@register("fn_gap", """
SELECT spec_no, spec, CASE WHEN regexp_matches(spec, '^(.*)\\*([0-9]+)$')
                           THEN repeat(regexp_extract(spec, '^(.*)\\*([0-9]+)$', 1), cast(regexp_extract(spec, '^(.*)\\*([0-9]+)$', 2) AS integer))
                           ELSE spec END AS gap
FROM v_gap_specs
""")
def q_fn_gap(spark, sf):
    g = V.view(spark, sf, "v_gap_specs")
    return g.select("spec_no", "spec", NM.expand_gap("spec").alias("gap"))


_EXT1 = "regexp_extract(file_name, '^(.*[^.].*)(\\.[^.]*)$', 2)"
_ROOT1 = f"substr(file_name, 1, length(file_name) - length({_EXT1}))"
_EXT2 = f"regexp_extract({_ROOT1}, '^(.*[^.].*)(\\.[^.]*)$', 2)"
_STEM = f"(CASE WHEN length({_EXT1}) > 1 AND {_EXT1} IN ('.gz', '.bz2', '.xz', '.lz') THEN substr({_ROOT1}, 1, length({_ROOT1}) - length({_EXT2})) ELSE {_ROOT1} END)"


@register("fn_ncbi", f"""
SELECT file_no, file_name, stem,
       CASE WHEN regexp_matches(stem, '^GC[FA]_([0-9]{{9}})\\.[0-9]+_.*$') THEN 'G' || regexp_extract(stem, '^GC[FA]_([0-9]{{9}})\\.[0-9]+_.*$', 1)
            ELSE stem END AS genome_id
FROM (SELECT file_no, file_name, {_STEM} AS stem FROM v_genome_files) s
""")
def q_fn_ncbi(spark, sf):
    f = V.view(spark, sf, "v_genome_files").withColumn("stem", NM.genome_stem("file_name"))
    return f.select("file_no", "file_name", "stem", NM.ncbi_id("stem").alias("genome_id"))


@register("fn_revcomp", "SELECT read_id, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS rc FROM v_reads")
def q_fn_revcomp(spark, sf):
    return V.view(spark, sf, "v_reads").select("read_id", NM.revcomp("seq").alias("rc"))


# --- reads: spike-in / host removal, duplicates, adapters, k-mer screen (PIPE2, PIPE3) -------
from ..operators import reads as RD  # noqa: E402
from ..operators import spikein as SP  # noqa: E402

ADAPTER_SPEC = "africa.fasta,america.fasta, ,asia.fasta,europe.fasta,middle east.fasta,ACGTTGCAAC"
ADAPTER_PRESET = "SYMMETRIC"
KMER_K = 21
KMER_MIN_SHARE = 0.1


@register("reads_anti_hits", """
SELECT r.sample_id, r.read_id FROM v_reads r
WHERE NOT EXISTS (SELECT 1 FROM v_read_hits h WHERE h.ref_id = 'plasmid' AND (h.flag & 4) = 0
                  AND h.sample_id = r.sample_id AND h.read_id = r.read_id)
""")
def q_reads_anti_hits(spark, sf):
    hits = V.view(spark, sf, "v_read_hits").filter(F.col("ref_id") == "plasmid")
    return RD.reads_without_hits(V.view(spark, sf, "v_reads"), hits).select("sample_id", "read_id")


@register("reads_anti_host", f"""
WITH r1 AS (SELECT r.sample_id, r.read_id FROM v_reads r
            WHERE NOT EXISTS (SELECT 1 FROM v_read_hits h WHERE h.ref_id = 'plasmid' AND (h.flag & 4) = 0
                              AND h.sample_id = r.sample_id AND h.read_id = r.read_id)),
host AS (SELECT sample_id, read_id FROM v_read_hits
         WHERE ref_id = 'host' AND (flag & 2052) = 0 AND {_ID} >= 0.999 AND {_QC} >= 0.95)
SELECT r1.sample_id, r1.read_id FROM r1
WHERE NOT EXISTS (SELECT 1 FROM host h WHERE h.sample_id = r1.sample_id AND h.read_id = r1.read_id)
""")
def q_reads_anti_host(spark, sf):
    hits = V.view(spark, sf, "v_read_hits")
    r1 = RD.reads_without_hits(V.view(spark, sf, "v_reads"), hits.filter(F.col("ref_id") == "plasmid"))
    return RD.reads_without_host(r1, hits.filter(F.col("ref_id") == "host")).select("sample_id", "read_id")


@register("read_dedup", """
WITH r AS (SELECT sample_id, read_id,
                  md5(least(seq, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')))) AS k,
                  CASE WHEN length(qual) > 0 THEN
                       cast(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) AS bigint) / length(qual)
                       ELSE 0.0 END AS mq
           FROM v_reads),
b AS (SELECT *, row_number() OVER (PARTITION BY sample_id, k ORDER BY mq DESC, read_id) AS rn,
             count(*) OVER (PARTITION BY sample_id, k) AS dup_count FROM r)
SELECT sample_id, read_id, mq AS mean_quality, dup_count FROM b WHERE rn = 1
""")
def q_read_dedup(spark, sf):
    return RD.dedup_reads(V.view(spark, sf, "v_reads")).select("sample_id", "read_id", "mean_quality", "dup_count")


_ADAPTERS_SQL = f"""
WITH items AS (SELECT cast(g.i AS integer) AS item_no, trim(string_split('{ADAPTER_SPEC}', ',')[g.i]) AS item
               FROM (SELECT unnest(range(1, len(string_split('{ADAPTER_SPEC}', ',')) + 1)) AS i) g),
adapters AS (SELECT i.item_no, f.adapter_id, f.seq FROM items i JOIN v_adapter_files f ON i.item = f.file_name
             UNION ALL
             SELECT item_no, 'adapter_' || item || '_' || cast(item_no AS varchar) AS adapter_id, upper(item) AS seq
             FROM items WHERE item <> '' AND item NOT IN (SELECT file_name FROM v_adapter_files)),
ad AS (SELECT adapter_id AS id, '+' AS orient, seq AS a, length(seq) AS n FROM adapters
       UNION ALL SELECT adapter_id, '-', reverse(translate(seq, 'ACGT', 'TGCA')), length(seq) FROM adapters),
h5 AS (SELECT r.sample_id, r.read_id, ad.id, ad.orient, ad.n, instr(substr(r.seq, 1, ad.n + 60), ad.a) - 1 AS off
       FROM v_lima_reads r, ad WHERE instr(substr(r.seq, 1, ad.n + 60), ad.a) > 0),
h3 AS (SELECT r.sample_id, r.read_id, ad.id, ad.orient, ad.n, instr(substr(reverse(r.seq), 1, ad.n + 60), reverse(ad.a)) - 1 AS off
       FROM v_lima_reads r, ad WHERE instr(substr(reverse(r.seq), 1, ad.n + 60), reverse(ad.a)) > 0),
b5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, read_id ORDER BY off, id, orient) AS rn FROM h5) x WHERE rn = 1),
b3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, read_id ORDER BY off, id, orient) AS rn FROM h3) x WHERE rn = 1),
t AS (SELECT r.sample_id, r.read_id, r.seq, r.qual, b5.id AS adapter5, b3.id AS adapter3,
             b5.off + b5.n AS s0, length(r.seq) - b3.off - b3.n AS s1,
             b5.id IS NOT NULL AND b3.id IS NOT NULL AND b5.id = b3.id AS fits
      FROM v_lima_reads r LEFT JOIN b5 ON r.sample_id = b5.sample_id AND r.read_id = b5.read_id
                          LEFT JOIN b3 ON r.sample_id = b3.sample_id AND r.read_id = b3.read_id),
trimmed AS (SELECT sample_id, read_id, adapter5, adapter3,
                   CASE WHEN fits AND s1 > s0 THEN 'trimmed' ELSE 'none' END AS outcome,
                   CASE WHEN fits AND s1 > s0 THEN substr(seq, s0 + 1, s1 - s0) END AS seq
            FROM t)
"""


def _adapters(spark, sf):
    return RD.adapter_set(ADAPTER_SPEC, V.view(spark, sf, "v_adapter_files"))


def _trimmed(spark, sf, mismatches=0):
    return RD.trim_adapters(V.view(spark, sf, "v_lima_reads"), _adapters(spark, sf), ADAPTER_PRESET,
                            mismatches=mismatches)


@register("adapter_set", _ADAPTERS_SQL + "SELECT item_no, adapter_id, seq FROM adapters")
def q_adapter_set(spark, sf):
    return _adapters(spark, sf)


@register("adapter_trim", _ADAPTERS_SQL + "SELECT * FROM trimmed")
def q_adapter_trim(spark, sf):
    return _trimmed(spark, sf).select("sample_id", "read_id", "adapter5", "adapter3", "outcome", "seq")


def _hamming_sql(side: str, read: str, adapter: str) -> str:
    """Lowest offset of every adapter with at most 2 mismatches, by comparing at every offset."""
    return f"""{side} AS (SELECT sample_id, read_id, id, orient, n, min(off) AS off FROM (
    SELECT r.sample_id, r.read_id, ad.id, ad.orient, ad.n, {adapter} AS x, {read} AS s, unnest(range(0, least(61, length(r.seq) - ad.n + 1))) AS off
    FROM v_lima_reads r, ad WHERE length(r.seq) >= ad.n) z
  WHERE hamming(substr(s, off + 1, n), x) <= 2 GROUP BY ALL),
"""


def _mismatch_sql() -> str:
    head, rest = _ADAPTERS_SQL.split("h5 AS (", 1)
    return (head + _hamming_sql("h5", "substr(r.seq, 1, ad.n + 60)", "ad.a")
            + _hamming_sql("h3", "substr(reverse(r.seq), 1, ad.n + 60)", "reverse(ad.a)") + "b5 AS (" + rest.split("b5 AS (", 1)[1])


@register("adapter_trim_mismatch", _mismatch_sql() + "SELECT * FROM trimmed")
def q_adapter_trim_mismatch(spark, sf):
    """Hamming search with 2 mismatches; the oracle compares every adapter at every offset."""
    return _trimmed(spark, sf, mismatches=2).select("sample_id", "read_id", "adapter5", "adapter3", "outcome", "seq")


@register("adapter_peek", _ADAPTERS_SQL + """,
seen AS (SELECT sample_id, read_id, id AS adapter_id FROM b5 UNION SELECT sample_id, read_id, id FROM b3),
tot AS (SELECT sample_id, count(*) AS n FROM v_lima_reads GROUP BY sample_id),
c AS (SELECT sample_id, adapter_id, count(DISTINCT read_id) AS n_reads FROM seen GROUP BY sample_id, adapter_id)
SELECT c.sample_id, c.adapter_id, c.n_reads, c.n_reads / tot.n AS share
FROM c JOIN tot ON c.sample_id = tot.sample_id WHERE c.n_reads / tot.n >= 0.01
""")
def q_adapter_peek(spark, sf):
    return RD.peek_adapters(V.view(spark, sf, "v_lima_reads"), _adapters(spark, sf), mismatches=0)


@register("audit_adapter", _ADAPTERS_SQL + """
SELECT sample_id, cast(sum(CASE WHEN outcome = 'trimmed' THEN 1 ELSE 0 END) AS bigint) AS n_trimmed, count(*) AS n_reads,
       CASE WHEN sum(CASE WHEN outcome = 'trimmed' THEN 1 ELSE 0 END) > 0 THEN 'trimmed' ELSE 'unchanged' END AS outcome
FROM trimmed GROUP BY sample_id
""")
def q_audit_adapter(spark, sf):
    return RD.sample_outcome(_trimmed(spark, sf))


@register("kmer_screen", f"""
WITH rk AS (SELECT sample_id, read_id, substr(seq, i + 1, {KMER_K}) AS kmer
            FROM (SELECT sample_id, read_id, seq, unnest(range(0, length(seq) - {KMER_K} + 1)) AS i FROM v_reads WHERE length(seq) >= {KMER_K}) x),
ref AS (SELECT DISTINCT substr(seq, i + 1, {KMER_K}) AS kmer
        FROM (SELECT seq, unnest(range(0, length(seq) - {KMER_K} + 1)) AS i FROM v_bench_ref WHERE length(seq) >= {KMER_K}) y),
sh AS (SELECT sample_id, read_id, count(*) AS n_shared FROM rk WHERE kmer IN (SELECT kmer FROM ref) GROUP BY sample_id, read_id),
tot AS (SELECT sample_id, read_id, cast(greatest(length(seq) - {KMER_K} + 1, 0) AS bigint) AS n_kmers FROM v_reads)
SELECT tot.sample_id, tot.read_id, tot.n_kmers, coalesce(sh.n_shared, 0) AS n_shared,
       tot.n_kmers > 0 AND coalesce(sh.n_shared, 0) >= {KMER_MIN_SHARE} * tot.n_kmers AS screened
FROM tot LEFT JOIN sh ON tot.sample_id = sh.sample_id AND tot.read_id = sh.read_id
""")
def q_kmer_screen(spark, sf):
    return RD.kmer_screen(V.view(spark, sf, "v_reads"), V.view(spark, sf, "v_bench_ref"), KMER_K, KMER_MIN_SHARE)


# --- spike-in fit (AGG10) ----------------------------------------------------------------------
@register("syndna_fit", """
WITH t AS (SELECT sample_id, sum(read_count) AS total FROM v_syndna GROUP BY sample_id),
c AS (SELECT s.sample_id, log10(s.read_count / t.total * 1e6) AS x, log10(s.mass_ng) AS y
      FROM v_syndna s JOIN t ON s.sample_id = t.sample_id WHERE t.total >= 1 AND s.read_count > 0 AND s.mass_ng > 0),
g AS (SELECT sample_id, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2,
             regr_count(y, x) AS n, var_pop(x) AS vx, var_pop(y) AS vy, avg(x) AS mx FROM c GROUP BY sample_id),
h AS (SELECT *, sign(slope) * sqrt(r2) AS rvalue FROM g),
k AS (SELECT *, CASE WHEN n - 2 > 0 AND vx > 0 THEN sqrt((1 - rvalue * rvalue) * vy / vx / (n - 2)) END AS se FROM h)
SELECT sample_id, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(rvalue, 6) AS rvalue,
       round(se, 6) AS stderr, round(se * sqrt(vx + mx * mx), 6) AS intercept_stderr, n
FROM k
""")
def q_syndna_fit(spark, sf):
    fits, _ = SP.calibrate(V.view(spark, sf, "v_syndna"))
    return fits.select("sample_id", r6("slope").alias("slope"), r6("intercept").alias("intercept"),
                       r6("rvalue").alias("rvalue"), r6("stderr").alias("stderr"),
                       r6("intercept_stderr").alias("intercept_stderr"), "n")


_FIT_CTES = ORACLE["syndna_fit"].rsplit("SELECT sample_id, round(slope", 1)[0]


@register("syndna_pvalue", _FIT_CTES.rstrip() + """,
a AS (SELECT *, n - 2 AS v, rvalue * sqrt((n - 2) / ((1 - rvalue) * (1 + rvalue))) AS t FROM k),
s AS (SELECT *, abs(t) / sqrt(v + t * t) AS sn, sqrt(v / (v + t * t)) AS cs FROM a),
-- the finite sums for even and odd degrees of freedom
q AS (SELECT *, CASE WHEN v % 2 = 0
    THEN 1 - sn * list_sum([list_product([(2 * i - 1) / (2.0 * i) for i in range(1, j + 1)] || [1.0]) * power(cs, 2 * j) for j in range(0, v // 2)])
    ELSE 1 - 2 / pi() * (atan2(abs(t), sqrt(v)) + sn * coalesce(list_sum(
         [list_product([(2.0 * i) / (2 * i + 1) for i in range(1, j + 1)] || [1.0]) * power(cs, 2 * j + 1) for j in range(0, (v - 1) // 2)]), 0)) END AS p FROM s)
SELECT sample_id, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(rvalue, 6) AS rvalue, round(p, 6) AS pvalue,
       round(se, 6) AS stderr, round(se * sqrt(vx + mx * mx), 6) AS intercept_stderr, n
FROM q
""")
def q_syndna_pvalue(spark, sf):
    """Full fit rows including the two-sided p-value."""
    fits, _ = SP.calibrate(V.view(spark, sf, "v_syndna"))
    return fits.select("sample_id", *[r6(c).alias(c) for c in ("slope", "intercept", "rvalue", "pvalue", "stderr", "intercept_stderr")], "n")


# --- small sources over derived tables (SRC14, SRC17, FLT13) -----------------------------------
@register("counts_last", """
SELECT sample_id, max(Counts) AS counts FROM v_lima_counts v
WHERE row_no = (SELECT max(row_no) FROM v_lima_counts w WHERE w.sample_id = v.sample_id) GROUP BY sample_id
""")
def q_counts_last(spark, sf):
    """SRC17: the Counts column of the last row (ties on the row number go to the larger count)."""
    c = V.view(spark, sf, "v_lima_counts")
    return c.groupBy("sample_id").agg(F.max_by("Counts", F.struct("row_no", "Counts")).alias("counts"))


@register("count_project", f"""
SELECT sample_id, regexp_replace(ref_id, '^All_synDNA_inserts\\.fasta/', '') AS feature_id, cast(count(*) AS double) AS value
FROM v_align WHERE ref_id <> '*' AND {_ID} >= 0.95 GROUP BY sample_id, ref_id
""")
def q_count_project(spark, sf):
    d = COV.contig_depth(A.min_filter(_aln(spark, sf), 0.95, 0.0), V.view(spark, sf, "v_lengths"))
    return FT_count_table(d)


def FT_count_table(depth):
    """FLT13: contig-depth rows -> COO counts: contig id without the reference-file prefix,
    the read count as the value, the sample id as the column."""
    return depth.select("sample_id",
                        F.regexp_replace("contig_id", r"^All_synDNA_inserts\.fasta/", "").alias("feature_id"),
                        F.col("read_count").cast("double").alias("value"))


@register("src_taxonomy", "SELECT * FROM v_tax_bac UNION ALL BY NAME SELECT * FROM v_tax_ar")
def q_src_taxonomy(spark, sf):
    bac = V.view(spark, sf, "v_tax_bac")
    ar = V.view(spark, sf, "v_tax_ar")
    return bac.unionByName(ar, allowMissingColumns=True)


# --- genome similarity and dereplication (SEQ4, SEQ5) ------------------------------------------
from ..operators import similarity as SM  # noqa: E402

# Parameters of the keys with small sketches; the other keys take the operator's own.
SK_K, SK_S = 21, 64


def _sketch_sql(k: int, s: int) -> str:
    return f"""
WITH km AS (SELECT genome_id, substr(seq, i + 1, {k}) AS km
            FROM (SELECT genome_id, seq, unnest(range(0, length(seq) - {k} + 1)) AS i
                  FROM v_drep_genomes WHERE length(seq) >= {k}) x),
hs AS (SELECT DISTINCT genome_id,
              ('0x' || substr(md5(least(km, reverse(translate(km, 'ACGT', 'TGCA')))), 1, 15))::bigint AS h FROM km),
sk AS (SELECT genome_id, h FROM (SELECT *, row_number() OVER (PARTITION BY genome_id ORDER BY h) AS r FROM hs) y
       WHERE r <= {s})
"""


_SKETCH_SQL = _sketch_sql(SK_K, SK_S)
_FULL_SKETCH_SQL = _sketch_sql(SM.SKETCH_K, SM.SKETCH_SIZE)


def _sketches(spark, sf, k: int = SM.SKETCH_K, s: int = SM.SKETCH_SIZE, make=SM.sketches):
    return make(V.view(spark, sf, "v_drep_genomes"), k, s, "md5")


@register("genome_sketch", _SKETCH_SQL + "SELECT * FROM sk")
def q_genome_sketch(spark, sf):
    return _sketches(spark, sf, SK_K, SK_S)


@register("genome_sketch_full", _FULL_SKETCH_SQL + "SELECT * FROM sk")
def q_genome_sketch_full(spark, sf):
    return _sketches(spark, sf)


@register("sketch_pairs", _SKETCH_SQL + f""",
rk AS (SELECT genome_id, -score AS sn FROM v_drep_genomes),
lead AS (SELECT h, arg_min(sk.genome_id, (rk.sn, sk.genome_id)) AS leader FROM sk JOIN rk ON sk.genome_id = rk.genome_id GROUP BY h),
e AS (SELECT DISTINCT sk.genome_id AS a, lead.leader AS b FROM sk JOIN lead ON sk.h = lead.h WHERE lead.leader <> sk.genome_id),
u AS (SELECT a, b, h, max(in_a) AS in_a, max(in_b) AS in_b FROM (
        SELECT e.a, e.b, sk.h, 1 AS in_a, 0 AS in_b FROM e JOIN sk ON sk.genome_id = e.a
        UNION ALL SELECT e.a, e.b, sk.h, 0, 1 FROM e JOIN sk ON sk.genome_id = e.b) z GROUP BY a, b, h),
low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY h) AS r FROM u) q WHERE r <= {SK_S}),
j AS (SELECT a, b, sum(in_a * in_b) / count(*) AS j FROM low GROUP BY a, b)
SELECT a, b, j, round(CASE WHEN j > 0 THEN 1 + ln(2 * j / (1 + j)) / {SK_K} END, 6) AS ani FROM j
""")
def q_sketch_pairs(spark, sf):
    scores = V.view(spark, sf, "v_drep_genomes").select("genome_id", "score")
    e = SM.leader_edges(_sketches(spark, sf, SK_K, SK_S, SM.coded_sketches), scores, SK_K, SK_S)
    return e.select("a", "b", "j", r6("ani").alias("ani"))


@register("genome_pairs", _FULL_SKETCH_SQL + f""",
size AS (SELECT genome_id, count(*) AS n FROM sk GROUP BY genome_id),
near AS (SELECT x.genome_id AS a, y.genome_id AS b FROM sk x JOIN sk y ON x.h = y.h AND x.genome_id <> y.genome_id
         JOIN size ON size.genome_id = x.genome_id GROUP BY x.genome_id, y.genome_id, size.n
         HAVING count(*) >= {SM.ani_to_j(SM.ANI_THRESHOLD, SM.SKETCH_K) / 2} * size.n),
u AS (SELECT a, b, h, max(in_a) AS in_a, max(in_b) AS in_b FROM (
        SELECT near.a, near.b, sk.h, 1 AS in_a, 0 AS in_b FROM near JOIN sk ON sk.genome_id = near.a
        UNION ALL SELECT near.a, near.b, sk.h, 0, 1 FROM near JOIN sk ON sk.genome_id = near.b) z GROUP BY a, b, h),
low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY h) AS r FROM u) q WHERE r <= {SM.SKETCH_SIZE}),
j AS (SELECT a, b, sum(in_a * in_b) / count(*) AS j FROM low GROUP BY a, b),
sim AS (SELECT a, b, j, 1 + ln(2 * j / (1 + j)) / {SM.SKETCH_K} AS ani FROM j
        WHERE j > 0 AND 1 + ln(2 * j / (1 + j)) / {SM.SKETCH_K} >= {SM.ANI_THRESHOLD}),
rk AS (SELECT genome_id, row_number() OVER (ORDER BY score DESC, genome_id) AS no FROM v_drep_genomes WHERE genome_id IN (SELECT genome_id FROM sk)),
nb AS (SELECT rk.no, any_value(rk.genome_id) AS genome_id, coalesce(list(other.no) FILTER (WHERE other.no < rk.no), []) AS better
       FROM rk LEFT JOIN sim ON sim.a = rk.genome_id LEFT JOIN rk other ON other.genome_id = sim.b GROUP BY rk.no),
reps AS (WITH RECURSIVE walk AS (
           SELECT 0::BIGINT AS no, []::BIGINT[] AS reps
           UNION ALL SELECT nb.no, CASE WHEN list_has_any(nb.better, walk.reps) THEN walk.reps ELSE list_append(walk.reps, nb.no) END
           FROM walk JOIN nb ON nb.no = walk.no + 1)
         SELECT unnest(reps) AS no FROM (SELECT reps FROM walk ORDER BY no DESC LIMIT 1) w),
found AS (SELECT sim.*, row_number() OVER (PARTITION BY a ORDER BY ani DESC, rk.no) AS nth
          FROM sim JOIN rk ON rk.genome_id = sim.b JOIN reps ON reps.no = rk.no)
SELECT a, b, j, round(ani, 6) AS ani, nth = 1 AS is_member FROM found
""")
def q_genome_pairs(spark, sf):
    """Genomes with every representative at or above the threshold; the oracle compares all pairs and walks the ranking."""
    scores = V.view(spark, sf, "v_drep_genomes").select("genome_id", "score")
    p = SM.representative_pairs(_sketches(spark, sf, make=SM.coded_sketches), scores)
    return p.select("a", "b", "j", r6("ani").alias("ani"), "is_member")


@register("dereplicate", ORACLE["genome_pairs"].rsplit("SELECT a, b, j, round(ani, 6)", 1)[0] + """
SELECT a AS genome_id, b AS rep_id, false AS is_rep, round(ani, 6) AS ani FROM found WHERE nth = 1
UNION ALL SELECT rk.genome_id, rk.genome_id, true, NULL FROM reps JOIN rk ON rk.no = reps.no
""")
def q_dereplicate(spark, sf):
    """Greedy representatives and membership; the oracle walks the ranking over all pairs."""
    scores = V.view(spark, sf, "v_drep_genomes").select("genome_id", "score")
    return SM.dereplicate(_sketches(spark, sf, make=SM.coded_sketches), scores).select("genome_id", "rep_id", "is_rep", r6("ani").alias("ani"))


# --- file sources: write a derived table with our sinks, read it back with our readers -------
# (SRC1, SRC3-SRC10).  The files live in a fresh folder under spark.checkpoint.dir; the oracle is
# the view itself, so a key passes only if the round trip is lossless.
from ..session import ensure_checkpoint_dir  # noqa: E402
from ..sources import seqio as SQ  # noqa: E402
from ..sources import tables as TB  # noqa: E402


def _scratch(spark, tag: str) -> str:
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/longtab-files/{tag}-{uuid.uuid4().hex}"


@register("src_fasta", "SELECT contig_id, seq FROM v_contigs")
def q_src_fasta(spark, sf):
    path = _scratch(spark, "fasta")
    SQ.write_fasta(V.view(spark, sf, "v_contigs"), path, width=60, compression="gzip")
    return SQ.read_fasta(spark, path, genome_from_file=False).select("contig_id", "seq")


_RANK = "CASE cast(substr(feature_id, 2) AS bigint) % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'KO' WHEN 2 THEN 'per-gene' ELSE 'other' END"


@register("feature_merge_ranked", f"""
SELECT rank, sample_id, feature_id, sum(value) AS value FROM (SELECT lower({_RANK}) AS rank, sample_id, feature_id, value FROM v_tables) t
WHERE rank IN ('none', 'per-gene', 'ko', 'ec', 'pathway') GROUP BY rank, sample_id, feature_id HAVING sum(value) <> 0
""")
def q_feature_merge_ranked(spark, sf):
    """SET6: merge by rank; unknown ranks are left out."""
    return FT.merge_ranked(V.view(spark, sf, "v_tables").withColumn("rank", F.expr(_RANK)), "woltka")


# --- ordered exports (SRT1, SRT2, SRT5): written in order, read back with the place of every row ---
from ..sources import exports as EX  # noqa: E402

_ALN_ORDER = ["sample_id", "read_id", "ref_id", "pos", "flag", "cigar", "tag_nm"]


def _sorted_copy(spark, df, tag, keys, ties):
    path = _scratch(spark, tag)
    EX.write_sorted(df, path, keys, ties)
    return EX.read_sorted(spark, path, keys)


@register("aln_sorted", """
SELECT sample_id, read_id, ref_id, pos, flag, row_number() OVER (ORDER BY sample_id, read_id, ref_id, pos, flag, cigar, tag_nm) AS row_no FROM v_align
""")
def q_aln_sorted(spark, sf):
    """SRT1: alignments by sample and read id."""
    return _sorted_copy(spark, _aln(spark, sf), "aln-sorted", _ALN_ORDER[:2], _ALN_ORDER[2:]).select(
        "sample_id", "read_id", "ref_id", "pos", "flag", "row_no")


@register("hits_sorted", """
SELECT ref_id, pos, sample_id, read_id, row_number() OVER (ORDER BY ref_id, pos, sample_id, read_id, flag, cigar, tag_nm) AS row_no
FROM v_align WHERE ref_id <> '*'
""")
def q_hits_sorted(spark, sf):
    """SRT5: hits by reference and coordinate."""
    hits = _aln(spark, sf).filter(F.col("ref_id") != "*")
    return _sorted_copy(spark, hits, "hits-sorted", ["ref_id", "pos"], ["sample_id", "read_id", "flag", "cigar", "tag_nm"]).select(
        "ref_id", "pos", "sample_id", "read_id", "row_no")


@register("genomes_sorted", """
SELECT genome_id, contig_id, length(seq) AS length, row_number() OVER (ORDER BY genome_id NULLS FIRST, ord) AS row_no FROM v_contigs
""")
def q_genomes_sorted(spark, sf):
    """SRT2: contigs in the order of their genomes' ids."""
    c = V.view(spark, sf, "v_contigs")
    out = _sorted_copy(spark, c, "genomes-sorted", ["genome_id"], ["ord"])
    return out.select("genome_id", "contig_id", F.length("seq").cast("long").alias("length"), "row_no")


@register("src_fastq", "SELECT sample_id, read_id, seq, qual FROM v_reads")
def q_src_fastq(spark, sf):
    path = _scratch(spark, "fastq")
    SQ.write_fastq(V.view(spark, sf, "v_reads"), path, partition_by="sample_id")
    return SQ.read_fastq(spark, path).select("sample_id", "read_id", "seq", "qual")


@register("src_gfa", "SELECT sample_id, rec_type, contig_id, seq FROM v_gfa")
def q_src_gfa(spark, sf):
    path = _scratch(spark, "gfa")
    g = V.view(spark, sf, "v_gfa")
    g.select("sample_id", F.concat_ws("\t", "rec_type", "contig_id", "seq").alias("value")).write.partitionBy("sample_id").text(path)
    return SQ.read_gfa(spark, path).select("sample_id", "rec_type", "contig_id", "seq")


@register("src_sam", "SELECT sample_id, read_id, flag, ref_id, pos, mapq, cigar, tag_nm, tag_md FROM v_align")
def q_src_sam(spark, sf):
    path = _scratch(spark, "sam")
    SQ.write_sam_text(_aln(spark, sf), path)
    return SQ.read_sam(spark, path).select("sample_id", "read_id", "flag", "ref_id", "pos", "mapq", "cigar", "tag_nm", "tag_md")


@register("src_manifest", _LOOKUP_SQL + """
SELECT sample_id, file_name AS path, cast(100 + file_no % 3 AS bigint) AS artifact_id FROM m WHERE sample_id IS NOT NULL
""")
def q_src_manifest(spark, sf):
    path = _scratch(spark, "manifest")
    m = LK.analysis_manifest(_matched(spark, sf).withColumn("artifact_id", (100 + F.col("file_no") % 3).cast("bigint")))
    TB.write_manifest(m, path)
    return TB.read_manifest(spark, path)


@register("src_lengths", "SELECT ref_id, length FROM v_lengths")
def q_src_lengths(spark, sf):
    path = _scratch(spark, "lengths")
    V.view(spark, sf, "v_lengths").write.option("sep", "\t").csv(path)
    return TB.read_lengths(spark, path)


@register("src_coords", "SELECT ref_id, gene_id, start, stop FROM v_genes")
def q_src_coords(spark, sf):
    path = _scratch(spark, "coords")
    g = V.view(spark, sf, "v_genes")
    # 1-based inclusive, every other gene written reversed (end first)
    line = F.when(F.col("start") % 2 == 0,
                  F.concat_ws("\t", "gene_id", (F.col("start") + 1).cast("string"), F.col("stop").cast("string"))) \
            .otherwise(F.concat_ws("\t", "gene_id", F.col("stop").cast("string"), (F.col("start") + 1).cast("string")))
    blocks = g.groupBy("ref_id").agg(F.array_join(F.collect_list(line), "\n").alias("_b"))
    blocks.select(F.concat(F.lit(">"), "ref_id", F.lit("\n"), "_b").alias("value")).write.text(path)
    return TB.read_coords(spark, path).select("ref_id", "gene_id", "start", "stop")


@register("src_maps", "SELECT map, source, target FROM v_maps")
def q_src_maps(spark, sf):
    maps = V.view(spark, sf, "v_maps")
    out = None
    for name in ("ko", "ec", "reaction", "module", "pathway"):
        path = _scratch(spark, f"map-{name}")
        (maps.filter(F.col("map") == name).groupBy("source")
             .agg(F.array_join(F.array_sort(F.collect_list("target")), "\t").alias("_t"))
             .select(F.concat_ws("\t", "source", "_t").alias("value")).write.text(path))
        one = TB.read_map(spark, path, name)
        out = one if out is None else out.unionByName(one)
    return out


@register("src_quality", """
SELECT cast(artifact_id AS varchar) || '_' || bin_id AS "Bin Id", completeness AS "Completeness",
       contamination AS "Contamination", strain_heterogeneity AS "Strain heterogeneity" FROM v_quality
""")
def q_src_quality(spark, sf):
    path = _scratch(spark, "quality")
    q = QL.merge_quality(V.view(spark, sf, "v_quality"))
    (q.select(F.col("genome_id").alias("Bin Id"), F.col("completeness").alias("Completeness"),
              F.col("contamination").alias("Contamination"),
              F.col("strain_heterogeneity").alias("Strain heterogeneity"))
      .write.option("sep", "\t").option("header", "true").option("compression", "gzip").csv(path))
    return TB.read_quality(spark, path).drop("file_name")


# --- whole commands (PIPE1-PIPE4) and genomes of several contigs (AGG5) ------------------------
from .. import pipelines as PL  # noqa: E402


def _profile_command(spark, sf):
    v = lambda name: V.view(spark, sf, name)
    return PL.profile(v("v_align"), v("v_lengths"), v("v_genes"), v("v_maps"), v("v_manifest"),
                      PROFILE_IDENTITY, PROFILE_COVERAGE)


_GENOME_CTES = f"""
pf AS (SELECT DISTINCT sample_id, read_id, ref_id FROM v_align WHERE {_FILTER} AND ref_id <> '*'),
pk AS (SELECT sample_id, read_id, ref_id, count(*) OVER (PARTITION BY sample_id, read_id) AS k FROM pf),
ps AS (SELECT sample_id, ref_id AS feature_id, round(sum(1.0::double / k), 9) AS v FROM pk GROUP BY sample_id, ref_id),
genome AS (SELECT sample_id, feature_id, cast(round_even(v, 0) AS double) AS value FROM ps WHERE round_even(v, 0) <> 0)
"""


@register("pipe_profile", _GENE_PROFILE_SQL + "," + _GENOME_CTES + """
SELECT 'none' AS rank, sample_id, feature_id, value FROM genome
UNION ALL SELECT 'per-gene', sample_id, feature_id, value FROM gene
UNION ALL SELECT 'ko', sample_id, feature_id, value FROM ko
UNION ALL SELECT 'ec', sample_id, feature_id, value FROM ec
UNION ALL SELECT 'pathway', sample_id, feature_id, value FROM pathway
""")
def q_pipe_profile(spark, sf):
    return _profile_command(spark, sf)["table"]


@register("pipe_profile_verdict", "WITH " + _GENOME_CTES.strip() + """,
n AS (SELECT sample_id, count(*) AS n FROM genome GROUP BY sample_id)
SELECT m.sample_id, coalesce(n.n, 0) AS n_rows, CASE WHEN coalesce(n.n, 0) > 0 THEN 'ok' ELSE 'missing' END AS outcome
FROM v_manifest m LEFT JOIN n ON m.sample_id = n.sample_id
""")
def q_pipe_profile_verdict(spark, sf):
    return _profile_command(spark, sf)["verdict"]


@register("pipe_spikein_reads", ORACLE["reads_anti_host"])
def q_pipe_spikein_reads(spark, sf):
    hits = V.view(spark, sf, "v_read_hits")
    out = PL.spikein(V.view(spark, sf, "v_reads"), hits.filter(F.col("ref_id") == "plasmid"),
                     hits.filter(F.col("ref_id") == "host"), V.view(spark, sf, "v_syndna"), V.view(spark, sf, "v_manifest"))
    return out["reads"].select("sample_id", "read_id")


@register("pipe_adapter_verdict", _ADAPTERS_SQL + """,
o AS (SELECT sample_id, sum(CASE WHEN outcome = 'trimmed' THEN 1 ELSE 0 END) > 0 AS cut FROM trimmed GROUP BY sample_id)
SELECT count(*) AS n_samples, cast(sum(CASE WHEN cut THEN 1 ELSE 0 END) AS bigint) AS n_trimmed,
       cast(sum(CASE WHEN cut THEN 0 ELSE 1 END) AS bigint) AS n_unchanged, cast(0 AS bigint) AS n_missing,
       cast(0 AS bigint) AS n_failed, sum(CASE WHEN cut THEN 0 ELSE 1 END) < count(*) AS ok
FROM o
""")
def q_pipe_adapter_verdict(spark, sf):
    reads = V.view(spark, sf, "v_lima_reads")
    out = PL.adapter_removal(reads, V.view(spark, sf, "v_adapter_files"), ADAPTER_SPEC, reads.select("sample_id"),
                             ADAPTER_PRESET, mismatches=0)
    return out["verdict"]


_PASSED = ORACLE["binning_gate"].strip()


@register("pipe_assembly_genomes", f"""
WITH passed AS ({_PASSED})
SELECT sample_id, sample_id || '_' || binner || '_' || bin_id AS genome_id, contig_id, 'MAG' AS kind FROM {_BEST} b
WHERE sample_id IN (SELECT p.sample_id FROM passed p WHERE p.passed)
UNION ALL
SELECT sample_id, sample_id || '.' || contig_id AS genome_id, contig_id, kind FROM {_LCG} l WHERE kind = 'LCG'
""")
def q_pipe_assembly_genomes(spark, sf):
    return PL.assembly(V.view(spark, sf, "v_gfa"), V.view(spark, sf, "v_bins"), SMALL_KIB, GATE_BYTES)["genomes"]


_CONTIG_GENOMES = """SELECT ref_id, 'G' || cast(cast(substr(ref_id, 2) AS bigint) % 4 AS string) AS genome_id, length FROM v_lengths"""


@register("contig_genome_depth", f"""
WITH runs AS {Q.depth_runs(_REMAP, "sample_id, ref_id")},
g AS ({_CONTIG_GENOMES}),
tot AS (SELECT genome_id, cast(sum(length) AS bigint) AS length FROM g GROUP BY genome_id),
hist AS (SELECT r.sample_id, g.genome_id, depth, sum(stop - start) AS w FROM runs r JOIN g ON r.ref_id = g.ref_id WHERE depth > 0 GROUP BY ALL),
cum AS (SELECT h.*, t.length AS len, sum(w) OVER (PARTITION BY sample_id, h.genome_id ORDER BY depth) AS c,
               sum(w) OVER (PARTITION BY sample_id, h.genome_id) AS cov FROM hist h JOIN tot t ON t.genome_id = h.genome_id),
tm AS (SELECT sample_id, genome_id, sum(greatest(0, least(len - cov + c, len - floor(len * (1.0::DOUBLE - 0.95::DOUBLE)))
                - greatest(len - cov + c - w, floor(len * 0.05::DOUBLE))) * depth)
              / max(len - floor(len * (1.0::DOUBLE - 0.95::DOUBLE)) - floor(len * 0.05::DOUBLE)) AS trimmed_mean FROM cum GROUP BY ALL),
st AS (SELECT r.sample_id, g.genome_id, sum(CASE WHEN depth > 0 THEN stop - start ELSE 0 END) AS covered_bases,
              sum((stop - start) * depth) AS depth_sum FROM runs r JOIN g ON r.ref_id = g.ref_id GROUP BY r.sample_id, g.genome_id),
cnt AS (SELECT r.sample_id, g.genome_id, count(DISTINCT read_id) AS read_count FROM {_REMAP} r JOIN g ON r.ref_id = g.ref_id
        GROUP BY r.sample_id, g.genome_id)
SELECT st.sample_id, st.genome_id, cast(st.covered_bases AS bigint) AS covered_bases,
       round(tm.trimmed_mean, 6) AS trimmed_mean, round(st.depth_sum / tot.length, 6) AS mean, tot.length, cnt.read_count
FROM st JOIN tm ON tm.sample_id = st.sample_id AND tm.genome_id = st.genome_id JOIN tot ON st.genome_id = tot.genome_id JOIN cnt ON st.sample_id = cnt.sample_id AND st.genome_id = cnt.genome_id
""")
def q_contig_genome_depth(spark, sf):
    """AGG5 with several contigs per genome (every fourth reference belongs to the same genome)."""
    lengths = V.view(spark, sf, "v_lengths")
    genomes = lengths.select("ref_id", F.concat(F.lit("G"), (F.substring("ref_id", 2, 20).cast("bigint") % 4).cast("string")).alias("genome_id"))
    d = COV.genome_depth(_remap_alignments(spark, sf), lengths, genomes=genomes)
    return d.select("sample_id", "genome_id", "covered_bases", r6("trimmed_mean").alias("trimmed_mean"), r6("mean").alias("mean"),
                    "length", "read_count")


# --- the genome table command (PIPE5) ----------------------------------------------------------
# Pooled and gated genomes with N50 and score, contigs joined with the gap; then the ranking walk of ``dereplicate``.
_POOL_CTES = f"""
member AS (SELECT *, CASE WHEN kind = 'LCG' THEN '' ELSE cast(artifact_id AS varchar) || '_' END || genome_id AS pooled_id FROM v_pool_contigs),
good AS (SELECT *, CASE WHEN kind = 'LCG' THEN '' ELSE cast(artifact_id AS varchar) || '_' END || bin_id AS pooled_id FROM v_pool_quality
         WHERE completeness >= {QL.MIN_COMPLETENESS} AND contamination <= {QL.MAX_CONTAMINATION}),
half AS (SELECT pooled_id, max(len) AS n50 FROM (
  SELECT pooled_id, len, sum(len) OVER (PARTITION BY pooled_id ORDER BY len DESC, contig_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum(len) OVER (PARTITION BY pooled_id) AS tot
  FROM (SELECT pooled_id, contig_id, cast(length(seq) AS bigint) AS len FROM member) c) w WHERE 2 * cum >= tot GROUP BY pooled_id),
pool AS (SELECT good.pooled_id AS genome_id, s.seq,
                CASE WHEN n50 > 0 THEN completeness - 5.0::DOUBLE * contamination + contamination * strain_heterogeneity / 100.0::DOUBLE + 0.5::DOUBLE * log10(n50) END AS score
         FROM good JOIN half ON half.pooled_id = good.pooled_id
         JOIN (SELECT pooled_id, string_agg(seq, repeat('N', 20) ORDER BY ord) AS seq FROM member WHERE length(seq) > 0 GROUP BY pooled_id) s
           ON s.pooled_id = good.pooled_id),
"""
_POOL_SQL = "WITH " + _POOL_CTES + ORACLE["genome_pairs"].rsplit("SELECT a, b, j, round(ani, 6)", 1)[0].strip()[4:].replace(
    "v_drep_genomes", "pool").rstrip() + f""",
kept AS (SELECT contig_id AS ref_id, pooled_id AS genome_id FROM member WHERE pooled_id IN (SELECT rk.genome_id FROM reps JOIN rk ON rk.no = reps.no)),
hits AS (SELECT a.sample_id, a.read_id, a.ref_id, kept.genome_id, pos - 1 AS start, pos - 1 + {Q.refspan()} AS stop
         FROM v_pool_aln a JOIN kept ON kept.ref_id = a.ref_id WHERE {_MAPPED_PRIMARY} AND {_ID} >= 0.95 AND {_QC} >= 0.9),
tab AS (SELECT sample_id, genome_id AS feature_id, cast(count(DISTINCT read_id) AS double) AS value FROM hits GROUP BY sample_id, genome_id)
"""


def _genome_command(spark, sf):
    v = lambda name: V.view(spark, sf, name)
    return PL.genome_table(v("v_pool_quality"), v("v_pool_contigs"), v("v_pool_aln"), v("v_pool_lengths"),
                           manifest=v("v_manifest"), tips=v("v_pool_tips"))


@register("pipe_genome_table", _POOL_SQL + "SELECT * FROM tab WHERE feature_id IN (SELECT tip FROM v_pool_tips)")
def q_pipe_genome_table(spark, sf):
    """PIPE5: gate, pooled names, score, de-replication, depth of the representatives, tree filter."""
    return _genome_command(spark, sf)["table"]


@register("pipe_genome_coverage", _POOL_SQL + f""",
iv AS {Q.islands("hits", "sample_id, ref_id")},
pooled AS {Q.islands("iv", "ref_id")},
c AS (SELECT sample_id, ref_id, sum(stop - start) AS covered FROM iv GROUP BY sample_id, ref_id
      UNION ALL SELECT '*' AS sample_id, ref_id, sum(stop - start) AS covered FROM pooled GROUP BY ref_id)
SELECT c.sample_id, c.ref_id, cast(c.covered AS bigint) AS covered, l.length, c.covered / l.length AS fraction
FROM c JOIN v_pool_lengths l ON c.ref_id = l.ref_id
""")
def q_pipe_genome_coverage(spark, sf):
    """AGG8 of the command: covered share of every representative's contigs, per sample and over all samples."""
    return _genome_command(spark, sf)["consolidated"]

"""Completion audits (REL10, AGG16, SRC18, SRC19).

Step status is a table ``(job_id, step, task, sample_id, state, message)`` with state in
``completed | skipped | failed``.  A task that stops early on purpose records ``skipped`` for
the later steps; skipped counts as done.  Failures stay rows (one per failed task and step)
instead of one concatenated message, so no group is ever collected into one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DONE_STATES = ("completed", "skipped")


def step_audit(status: DataFrame, expected: DataFrame, n_steps: int) -> DataFrame:
    """REL10: for each job and each step 1..n: expected tasks, done, failed, missing.

    ``expected`` is ``(job_id, task)``; steps are generated per job with ``sequence`` (no
    cross join)."""
    exp = expected.select("job_id", "task").distinct()
    per_job = exp.groupBy("job_id").agg(F.count("*").alias("expected"))
    grid = (per_job.select("job_id", "expected",
                           F.explode(F.sequence(F.lit(1), F.lit(n_steps))).alias("step"))
                   .withColumn("step", F.col("step").cast("bigint")))
    st = status.join(exp, ["job_id", "task"], "left_semi")
    per_task = st.groupBy("job_id", F.col("step").cast("bigint").alias("step"), "task").agg(
        F.max(F.col("state").isin(*DONE_STATES).cast("int")).alias("_done"),
        F.max((F.col("state") == "failed").cast("int")).alias("_failed"))
    counts = per_task.groupBy("job_id", "step").agg(
        F.sum("_done").cast("bigint").alias("done"), F.sum("_failed").cast("bigint").alias("failed"))
    out = grid.join(counts, ["job_id", "step"], "left").fillna(0, ["done", "failed"])
    return out.withColumn("missing", F.col("expected") - F.col("done"))


def job_verdict(steps: DataFrame) -> DataFrame:
    """AGG16: one row per job: ok when nothing failed and nothing is missing."""
    return (steps.groupBy("job_id").agg(
                F.sum("failed").cast("bigint").alias("n_failed"),
                F.sum("missing").cast("bigint").alias("n_missing"))
            .withColumn("ok", (F.col("n_failed") == 0) & (F.col("n_missing") == 0)))


def failures(status: DataFrame) -> DataFrame:
    """The failure messages, one row each (the reference concatenates them into one text)."""
    return status.filter(F.col("state") == "failed").select("job_id", "step", "task", "sample_id", "message")


def outcome_by_suffix(files: DataFrame, path_col: str = "path") -> DataFrame:
    """SRC19: classify output files: ``*.fastq.gz`` is the input copied unchanged, ``*.fastq`` the trimmed reads."""
    p = F.col(path_col)
    return files.withColumn("outcome", F.when(p.endswith(".fastq.gz"), "unchanged")
                            .when(p.endswith(".fastq"), "trimmed").otherwise("other"))


def sample_audit(per_sample: DataFrame, expected: DataFrame, outcome_col: str = "outcome") -> DataFrame:
    """AGG16 for per-sample jobs (adapter, spike-in): expected samples with no outcome are
    'missing'.  Returns rows ``(sample_id, outcome)`` including the missing ones."""
    return (expected.select("sample_id").distinct()
                    .join(per_sample.select("sample_id", outcome_col), "sample_id", "left")
                    .select("sample_id", F.coalesce(F.col(outcome_col), F.lit("missing")).alias("outcome")))


def table_audit(manifest: DataFrame, table: DataFrame) -> DataFrame:
    """AGG16 for per-sample tables: expected samples with their number of rows; 'missing' without any."""
    n = table.groupBy("sample_id").agg(F.count("*").alias("n_rows"))
    return (manifest.select("sample_id").distinct().join(n, "sample_id", "left").fillna(0, ["n_rows"])
                    .withColumn("outcome", F.when(F.col("n_rows") > 0, "ok").otherwise("missing")))


def job_outcome(sample_outcomes: DataFrame) -> DataFrame:
    """One row: counts per outcome and the verdict.  All samples 'unchanged' is an error, as is
    any 'missing' or 'failed' sample."""
    c = lambda v: F.sum(F.when(F.col("outcome") == v, 1).otherwise(0)).cast("bigint")
    agg = sample_outcomes.agg(F.count("*").alias("n_samples"), c("trimmed").alias("n_trimmed"),
                              c("unchanged").alias("n_unchanged"), c("missing").alias("n_missing"),
                              c("failed").alias("n_failed"))
    return agg.withColumn("ok", (F.col("n_missing") == 0) & (F.col("n_failed") == 0)
                          & (F.col("n_unchanged") < F.col("n_samples")))

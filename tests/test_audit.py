from longtab.operators import audit as AU


def test_step_audit(spark):
    status = spark.createDataFrame(
        [("J", 1, 1, "a", "completed", ""), ("J", 1, 2, "b", "completed", ""),
         ("J", 2, 1, "a", "completed", ""), ("J", 2, 2, "b", "failed", "boom"),
         ("J", 3, 1, "a", "skipped", "")],
        "job_id string, step long, task long, sample_id string, state string, message string")
    expected = spark.createDataFrame([("J", 1), ("J", 2)], "job_id string, task long")
    steps = {r.step: (r.expected, r.done, r.failed, r.missing) for r in AU.step_audit(status, expected, 3).collect()}
    assert steps == {1: (2, 2, 0, 0), 2: (2, 1, 1, 1), 3: (2, 1, 0, 1)}
    v = AU.job_verdict(AU.step_audit(status, expected, 3)).first()
    assert (v.ok, v.n_failed, v.n_missing) == (False, 1, 2)
    assert [r.message for r in AU.failures(status).collect()] == ["boom"]


def test_job_outcome_all_unchanged_is_error(spark):
    so = spark.createDataFrame([("a", "unchanged"), ("b", "unchanged")], "sample_id string, outcome string")
    assert AU.job_outcome(so).first().ok is False
    so2 = spark.createDataFrame([("a", "trimmed"), ("b", "unchanged")], "sample_id string, outcome string")
    assert AU.job_outcome(so2).first().ok is True


def test_outcome_by_suffix(spark):
    f = spark.createDataFrame([("a.fastq.gz",), ("a.fastq",), ("a.txt",)], "path string")
    assert [r.outcome for r in AU.outcome_by_suffix(f).collect()] == ["unchanged", "trimmed", "other"]

from longtab.operators import alignments as A


def test_fraction_normalisation():
    assert A.fraction(99.9) == 0.999
    assert A.fraction(95) == 0.95
    assert A.fraction(0.9) == 0.9
    assert A.fraction(1) == 0.01


def _aln(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, read_id string, flag int, ref_id string, "
                                       "pos long, cigar string, tag_nm long")


def test_strict_filter_at_threshold(spark):
    # identity exactly 0.9 must fail the strict filter, pass the minimum filter
    rows = [("s", "r1", 0, "g", 1, "9=1X", 1), ("s", "r2", 0, "g", 1, "19=1X", 1)]
    a = _aln(spark, rows)
    assert [r.read_id for r in A.identity_coverage_filter(a, 0.9, 0.5).collect()] == ["r2"]
    assert sorted(r.read_id for r in A.min_filter(a, 90, 0).collect()) == ["r1", "r2"]


def test_min_filter_percent_boundary(spark):
    rows = [("s", "r1", 0, "g", 1, "999=1X", 1), ("s", "r2", 0, "g", 1, "998=1X", 1)]
    out = [r.read_id for r in A.min_filter(_aln(spark, rows), 99.9, 95).collect()]
    assert out == ["r1"]


def test_flag_filter(spark):
    rows = [("s", f"r{f}", f, "g", 1, "5=", 0) for f in (0, 4, 16, 256, 2048, 2064)]
    keep = sorted(r.flag for r in A.flag_filter(_aln(spark, rows)).collect())
    assert keep == [0, 16]

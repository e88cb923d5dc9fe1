from pyspark.sql import functions as F

from longtab.functions import cigar as C


def _eval(spark, rows, *exprs):
    df = spark.createDataFrame(rows, "cigar string, tag_nm long")
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_identity_eqx_and_m_forms_agree(spark):
    # 3S 40= 2X 1D 5I : matches 40, columns 48
    rows = [("3S40=2X1D5I", 8), ("3S42M1D5I", 8), ("*", 0), ("10H5=", 0)]
    out = _eval(spark, rows, C.seq_identity("cigar", "tag_nm"), C.query_coverage("cigar"),
                C.reference_span("cigar"), C.query_span("cigar"))
    assert out[0][0] == 40 / 48 and out[1][0] == 40 / 48
    assert out[0][1] == 47 / 50                      # (40+2+5) / (40+2+5+3)
    assert out[0][2] == 43 and out[0][3] == 50       # ref span M=XD ; query span M=XIS
    assert out[2] == (None, None, 0, 0)              # unmapped
    assert out[3][1] == 5 / 15                       # hard clips count in the denominator


def test_digits_of_previous_run_not_captured(spark):
    out = _eval(spark, [("12S140=", 0)], C.op_sum("cigar", "="), C.op_sum("cigar", "S"))
    assert out == [(140, 12)]


def test_coords_half_open(spark):
    df = spark.createDataFrame([(11, "2S5=1D3=")], "pos long, cigar string")
    r = C.with_alignment_coords(df).select("start", "stop").first()
    assert (r.start, r.stop) == (10, 19)

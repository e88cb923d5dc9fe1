from longtab.operators import profile as P


def test_split_and_half_even_rounding(spark):
    # r1 -> {a, b, c}: 1/3 each; r2 -> {a, b}: 1/2; r3 -> a ; r4 -> {b, c, c(dup)} -> 1/2 each
    rows = [("s", "r1", "a"), ("s", "r1", "b"), ("s", "r1", "c"), ("s", "r2", "a"), ("s", "r2", "b"),
            ("s", "r3", "a"), ("s", "r4", "b"), ("s", "r4", "c"), ("s", "r4", "c")]
    hits = spark.createDataFrame(rows, "sample_id string, read_id string, ref_id string")
    raw = {r.feature_id: r.value for r in P.split_counts(hits, "ref_id", rounded=False).collect()}
    assert abs(raw["a"] - (1 / 3 + 1 / 2 + 1)) < 1e-12
    out = {r.feature_id: r.value for r in P.split_counts(hits, "ref_id").collect()}
    # a = 1.8333 -> 2 ; b = 1/3+1/2+1/2 = 1.333 -> 1 ; c = 1/3 + 1/2 = 0.8333 -> 1
    assert out == {"a": 2.0, "b": 1.0, "c": 1.0}


def test_tie_rounds_to_even_and_zero_dropped(spark):
    # f gets 1/2 (rounds to 0, dropped); g gets 1/2 + 1/2 + 1/2 = 1.5 -> 2
    rows = [("s", "r1", "f"), ("s", "r1", "g"), ("s", "r2", "g"), ("s", "r2", "h"),
            ("s", "r3", "g"), ("s", "r3", "h")]
    hits = spark.createDataFrame(rows, "sample_id string, read_id string, ref_id string")
    out = {r.feature_id: r.value for r in P.split_counts(hits, "ref_id").collect()}
    assert out == {"g": 2.0, "h": 1.0}


def test_collapse_one_to_many_and_divide(spark):
    t = spark.createDataFrame([("s", "p1", 4.0), ("s", "p2", 2.0), ("s", "p3", 5.0)],
                              "sample_id string, feature_id string, value double")
    m = spark.createDataFrame([("p1", "K1"), ("p1", "K2"), ("p2", "K1")], "source string, target string")
    full = {r.feature_id: r.value for r in P.collapse(t, m).collect()}
    assert full == {"K1": 6.0, "K2": 4.0}          # p3 unmapped is dropped
    div = {r.feature_id: r.value for r in P.collapse(t, m, divide=True).collect()}
    assert div == {"K1": 4.0, "K2": 2.0}

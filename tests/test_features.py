import pytest

from longtab.operators import features as FT


def test_tree_tips_skip_inner_labels_and_replace_spaces(spark):
    t = spark.createDataFrame([("((a:1,b c:2)inner:3,(d,e)x);",)], "newick string")
    assert sorted(r.tip for r in FT.tree_tips(t).collect()) == ["a", "b_c", "d", "e"]


def test_tree_tips_quoted_labels(spark):
    import duckdb
    from longtab.plans import catalog
    nwk = "(('a,b':1,'it''s x'),c_d[&n=1]:3,'(q)')'in,(ner)':2,(e)'x,(y)'[&c,(z)];"
    t = spark.createDataFrame([(nwk,)], "newick string")
    got = sorted(r.tip for r in FT.tree_tips(t).collect())
    assert got == ["(q)", "a,b", "c_d", "e", "it's_x"]
    con = duckdb.connect()
    con.execute("CREATE TABLE v_tree (newick VARCHAR)")
    con.execute("INSERT INTO v_tree VALUES (?)", [nwk])
    assert sorted(r[0] for r in con.execute("SELECT tip FROM " + catalog._TIPS + " t").fetchall()) == got


def test_tree_filter_and_removed_partition_the_features(spark):
    table = spark.createDataFrame([("s1", "a", 1.0), ("s1", "z", 2.0), ("s2", "b_c", 3.0)],
                                  "sample_id string, feature_id string, value double")
    tips = FT.tree_tips(spark.createDataFrame([("(a,b c);",)], "newick string"))
    kept = {r.feature_id for r in FT.tree_filter(table, tips).collect()}
    gone = {r.feature_id for r in FT.tree_removed(table, tips).collect()}
    assert kept == {"a", "b_c"} and gone == {"z"}
    assert FT.shape_changed(table, tips)


def test_merge_keeps_totals_and_reports_duplicates(spark):
    rows = [("t1", "s1", "a", 1.0), ("t1", "s1", "b", 2.0), ("t2", "s2", "a", 5.0), ("t3", "s1", "a", 1.0),
            ("t4", "s9", "a", 0.0)]
    t = spark.createDataFrame(rows, "table_id string, sample_id string, feature_id string, value double")
    merged = FT.merge_tables(t)
    # s1 is in two tables: refused (reported below), not added up
    assert [(r.sample_id, r.value) for r in merged.collect()] == [("s2", 5.0)]
    assert [(r.sample_id, r.n_tables) for r in FT.duplicate_samples(t).collect()] == [("s1", 2)]
    assert merged.filter("sample_id = 's9'").count() == 0        # all-zero table skipped


def test_ranks_and_wide_roundtrip(spark):
    assert FT.ranks_for("WOLTKA") == ("none", "per-gene", "ko", "ec", "pathway")
    with pytest.raises(ValueError):
        FT.ranks_for("other")
    t = spark.createDataFrame([("s1", "a", 1.0), ("s2", "a", 2.0), ("s2", "b", 3.0)],
                              "sample_id string, feature_id string, value double")
    back = FT.from_wide(FT.to_wide(t, ["s1", "s2"]))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t.collect()))


def test_sample_totals_empty_table_is_zero(spark):
    man = spark.createDataFrame([("s1",), ("s2",)], "sample_id string")
    counts = spark.createDataFrame([("s1", 3)], "sample_id string, value long")
    out = {r.sample_id: (r.total, r.state) for r in FT.sample_totals(man, counts).collect()}
    assert out == {"s1": (3, "ok"), "s2": (0, "empty")}


def test_merge_by_rank_refuses_samples_of_two_tables(spark):
    rows = [("t1", "KO", "a", "k1", 1.0), ("t1", "ko", "a", "k1", 2.0), ("t2", "ko", "b", "k1", 4.0), ("t1", "ec", "c", "e", 1.0),
            ("t2", "ec", "c", "e", 1.0), ("t2", "ko", "c", "k2", 8.0), ("t1", "junk", "a", "x", 1.0), ("t1", "ec", "d", "e", 0.0)]
    df = spark.createDataFrame(rows, "table_id string, rank string, sample_id string, feature_id string, value double")
    assert sorted(map(tuple, FT.merge_ranked(df, "WOLTKA").collect())) == [("ko", "a", "k1", 3.0), ("ko", "b", "k1", 4.0), ("ko", "c", "k2", 8.0)]
    assert FT.merge_ranked(df.drop("table_id"), "woltka").filter("rank = 'ec'").count() == 1

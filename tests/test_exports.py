from pyspark.sql import functions as F

from longtab.sources import exports as EX


def test_parts_in_name_order_are_sorted(spark, tmp_path):
    rows = [("hot", i % 7, i) for i in range(3000)] + [(f"k{i % 50}", i, i) for i in range(500)] + [(None, 1, 9000), (None, 0, 9001)]
    df = spark.createDataFrame(rows, "k string, t long, no long").repartition(6)
    path = str(tmp_path / "out")
    ranges = EX.write_sorted(df, path, ["k"], ["t", "no"], parts=8).orderBy("file_name").collect()
    assert len(ranges) > 3 and sum(r.rows for r in ranges) == len(rows)
    assert max(r.rows for r in ranges) < 0.5 * len(rows)                    # the hot key is split
    key = lambda k: (k is not None, k or "")
    assert all(key(a.last.k) <= key(b.first.k) for a, b in zip(ranges, ranges[1:]))
    got = [(r.k, r.t, r.no) for r in EX.read_sorted(spark, path, ["k"]).orderBy("row_no").collect()]
    assert got == sorted(rows, key=lambda r: (key(r[0]), r[1], r[2]))
    text = str(tmp_path / "text")
    EX.write_sorted_text(df.withColumn("line", F.concat_ws("\t", "k", "no")), text, "line", ["k"], ["t", "no"], parts=4, compression="none")
    lines = [x for f in sorted((tmp_path / "text").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == [f"{k}\t{no}" if k else str(no) for k, _, no in got]


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "k string, t long")
    EX.write_sorted(df, str(tmp_path / "e"), ["k"])
    assert EX.read_sorted(spark, str(tmp_path / "e"), ["k"]).count() == 0

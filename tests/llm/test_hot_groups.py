"""Large groups: near copies in a shard, rows that share an id, the pipeline's stages against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from longtab.llm import ann, mixing


@pytest.mark.parametrize("sd", [1e-4, 1e-2])
def test_near_copies_are_reached_and_found(sd):
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(size=(1, 32)) + sd * rng.normal(size=(1400, 32)), rng.normal(size=(100, 32))]
    small = ann._small(x, *ann._frame(x))
    graph, entry = ann.build(small)
    assert ann.reached(graph, entry).all()
    found, _ = ann.beam_search(small, graph, small[:100], entry, ann.QUERY_BEAM)
    hit = 0
    for i in range(100):
        d = ((x - x[i]) ** 2).sum(axis=1)
        mine = found[i][found[i] >= 0]
        hit += len(set(np.argsort(d)[:11].tolist()) & set(mine[np.argsort(d[mine])][:11].tolist()))
    assert hit >= 0.95 * 1100


def test_near_copies_through_spark(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(1, 16)) + 1e-4 * rng.normal(size=(1200, 16)))
    df = spark.createDataFrame([(i, v.tolist(), "s", 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, shard string, block int")
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).toPandas()
    hit = 0
    for q in range(0, 1200, 100):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hit += len(set(np.argsort(d)[:10].tolist()) & set(got[got.query_id == q].vec_id))
    assert len(got) == 120 and hit >= 0.95 * 120


def test_rows_of_one_id_are_spread_and_share_the_copies(spark):
    rows = [(None, "one two three", "a")] * 3000 + [(i, "four words are here", "a") for i in range(500)] + [(7, "x y", None)] * 5
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, source string, no string, at int").repartition(4)
    got = mixing.decide(docs)
    by = {r.doc_id: r for r in got.groupBy("doc_id").agg(F.sum("copies").alias("c"), F.count("*").alias("n")).collect()}
    assert by[None].n == 3000 and by[7].n == 6 and got.count() == len(rows)
    for r in got.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("w"), F.first("target").alias("t")).collect():
        assert abs(r.w - r.t) <= 8
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == got.agg(F.sum("copies")).first()[0]
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("size"), F.monotonically_increasing_id().alias("no"))
    lots = sized.where("doc_id is null").groupBy(F.pmod(F.xxhash64("no"), F.lit(mixing.SALTS))).count()
    assert lots.agg(F.max("count")).first()[0] < 100
    assert sorted(r["at"] for r in mixing.ranked(sized).where("source = 'a'").collect()) == list(range(1, 3501))

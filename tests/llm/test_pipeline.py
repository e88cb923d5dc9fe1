import corpus_pipeline as CP
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    keys = list(E.queries())
    assert "pipeline" in keys and all(sum(k.startswith(f"op{n}_") for k in keys) == 1 for n in range(1, 14))


def test_stages_keep_columns_and_pack_everything(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in CP.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toArrow())
        assert docs.columns == CP.COLUMNS, name
        assert docs.count() > 0 and (name == "mixing" or docs.count() <= n)
    out = CP.STAGES[-1][1](spark, docs, SF)
    assert out.where("piece = 0").count() == docs.count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in CP.STAGES:
        assert stage(spark, docs, SF).count() == 0

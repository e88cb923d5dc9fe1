import math

import duckdb
import pandas as pd

import __spark_entry__ as E
from longtab.plans.views import TABLES

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["sample_id", "feature_id", "value"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_some_queries_match_oracle_at_smoke_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    for key in ("genome_profile", "cov_intervals", "sample_lookup", "best_bin", "feature_merge", "read_dedup"):
        s = E.queries()[key](spark, SMOKE).toPandas()
        d = con.execute(E.oracle_sql()[key]).df()
        cols = sorted(s.columns)
        assert cols == sorted(d.columns), key
        assert _rows(s, cols) == _rows(d, cols), key


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "None"
    if isinstance(v, float) and v.is_integer():
        return repr(int(v))
    return repr(v)


def _rows(df, cols):
    return sorted(tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False))

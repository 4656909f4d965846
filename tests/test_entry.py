"""Driver contract: entry runs, every oracle key is a query key, and a few
queries agree with their DuckDB oracle on sf0.001."""

import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark, sf_small):
    df = load_entry().entry(spark)
    rows = df.collect()
    assert {r["metric"] for r in rows} >= {"ndcg_10", "map_10", "rmse", "hit_rate_20"}


def test_oracle_keys_subset():
    m = load_entry()
    assert set(m.oracle_sql()) <= set(m.queries())
    assert len(m.queries()) >= 90


@pytest.mark.parametrize("key", ["user_profiles", "eval_report", "ab_stats", "item_knn",
                                 "request_summary", "profile_asof"])
def test_oracle_agreement(spark, sf_small, key):
    m = load_entry()
    con = duckdb.connect()
    from rankforge.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    s = m.queries()[key](spark, sf_small).toPandas()
    o = con.execute(m.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    cols = sorted(s.columns)
    key_rows = lambda df: sorted(map(str, df[cols].astype(str).values.tolist()))
    assert key_rows(s) == key_rows(o)

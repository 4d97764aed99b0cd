"""Driver contract and oracle agreement on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["lineitem", "orders", "events"]
QUICK = ["health_category_daily", "missing_dates", "live_features", "latest_forecast",
         "category_distribution", "forecast_features"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "health_category" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip("0: T") == "" else str(v)
    return v


@pytest.mark.parametrize("name", QUICK)
def test_matches_sql_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    got = E.queries()[name](spark, sf_small).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda df: sorted(tuple(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    assert rows(got) == rows(want)

"""Driver contract and a DuckDB oracle comparison on a subset of queries at sf0.001."""
import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from conftest import SF

TABLES = "region nation customer supplier part orders lineitem".split()
SUBSET = ["flagship_share_trend", "w1_lags", "w12_yoy", "w17_spikes", "c8_calendar_on_sales",
          "a1_store_behaviour", "a13_store_quality", "a21_platform_preference", "a29_store_rank_in_brand_platform",
          "l1_split_summary", "m13_baseline_metrics_by_split", "x6_month_platform_pivot",
          "m16_linear_coefficients", "j5_open_orders_by_month", "s14_committed_snapshot", "q1_integrity", "x13_levels"]


def norm(df):
    df = df[sorted(df.columns)]
    out = df.astype(object).where(pd.notna(df), None)
    return sorted((tuple(r) for r in out.itertuples(index=False)), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", SUBSET)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = entry_mod.queries()[name](spark, SF).toPandas()
    exp = con.execute(entry_mod.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert norm(got) == norm(exp)

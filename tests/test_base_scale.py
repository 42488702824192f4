"""The base fact and the splits at scale: narrow group keys, compiled windows, equal rows."""
from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import SF
from salesplane.functions.exprs import cents
from salesplane.operators import splits as sp
from salesplane.plans.base import base
from salesplane.sources.tpch import sales_from_tpch


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cents_equal_decimal_rounding(spark):
    xs = [0.0, 0.005, 0.015, 1.005, 2.675, 0.125, -0.125, -1.005, 0.0049999999999999994, 19.999, 12345678.905, 9e12, 3e13, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select(cents("x").alias("a"), F.round(F.col("x") * 100).cast("long").alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]


def test_rows_are_grouped_by_keys_before_names(spark):
    plan = _optimized(sales_from_tpch(spark, SF, sparse=True)).splitlines()
    (at,) = [i for i, line in enumerate(plan) if "Aggregate" in line and "l_partkey" in line]
    assert "n_name" not in plan[at] and "s_nationkey" in plan[at]
    # the brand's number is taken from the part table, not from the fact
    assert all("part" in "".join(plan[i:i + 4]) and "lineitem" not in plan[i] and i > at for i, x in enumerate(plan) if "regexp_extract" in x)


def test_repeated_nations_count_their_lines_again(spark, tmp_path):
    day = datetime(2000, 3, 5)
    tables = {"lineitem": ([(1, 1, 1, 2.0, 10.01, day), (1, 1, 1, 3.0, 5.005, day)],
                           "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp"),
              "orders": ([(1, 1)], "o_orderkey long, o_custkey long"), "customer": ([(1, "A")], "c_custkey long, c_mktsegment string"),
              "supplier": ([(1, 3)], "s_suppkey long, s_nationkey int"), "part": ([(1, "Brand#12")], "p_partkey long, p_brand string"),
              "nation": ([(3, "X"), (3, "X"), (3, None)], "n_nationkey int, n_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    out = sales_from_tpch(spark, str(tmp_path)).collect()
    assert sorted((r["store_name"] or "", r["sales_amount"], r["sales_quantity"]) for r in out) == [("", 15.02, 5.0), ("X", 30.04, 10.0)]
    assert {r["sales_month"] for r in out} == {date(2000, 3, 1)}


def test_windows_are_compiled_conditions(spark):
    windows = sp.expanding_windows(1999)
    b = base(spark, SF)
    for df in (sp.tag_splits(b, windows), sp.in_windows(b, windows, "val")):
        assert "lambda" not in _optimized(df)


def test_split_frames_equal_tagged_rows(spark):
    rows = [(date(1999, 2, 1), 1), (date(2000, 1, 1), 2), (date(2000, 5, 1), 3), (None, 4), (date(2009, 1, 1), 5), (date(2000, 5, 1), 3)]
    df, windows = spark.createDataFrame(rows, "sales_month date, x int"), sp.expanding_windows(1999)
    tagged = sorted((r["split_id"], r["role"], r["x"]) for r in sp.tag_splits(df, windows).collect())
    assert {t[0] for t in tagged} == {1, 2}  # the other splits have no validation rows
    frames = sp.split_frames(df, windows)
    assert tagged == sorted((r["split_id"], role, r["x"]) for _, *pair in frames for role, f in zip(("train", "val"), pair) for r in f.collect())

from datetime import date

from pyspark.sql import functions as F

from conftest import SF
from salesplane.operators import metrics as mt
from salesplane.operators import model as md
from salesplane.operators import splits as sp
from salesplane.functions.stats import quantiles
from salesplane.plans.base import base


def test_splits_disjoint_and_ordered(spark):
    t = sp.tag_splits(base(spark, SF), sp.expanding_windows(1999))
    s = sp.split_summary(t).collect()
    assert {r["split_id"] for r in s} == {1, 2, 3, 4, 5}
    assert all(r["ordered"] == 1 for r in s)


def test_no_holdout_split_absent(spark):
    b = base(spark, SF).where(F.year("sales_month") < 2001)
    t = sp.tag_splits(b, sp.expanding_windows(1999))
    assert 5 not in {r["split_id"] for r in t.select("split_id").distinct().collect()}


def test_history_windows_are_the_expanding_ones_carried_on():
    assert sp.history_windows(date(1999, 3, 1), date(2001, 3, 1)) == sp.expanding_windows(1999)
    more = sp.history_windows(date(1995, 1, 1), date(2001, 11, 1))
    assert [w[0] for w in more] == list(range(1, 25)) and {w[1] for w in more} == {date(1995, 1, 1)}
    assert more[-1][2:] == (date(2001, 10, 1), date(2001, 10, 1), date(2002, 1, 1), "1995_full+1996_full+1997_full+1998_full+1999_full+2000_full+2001_Q1Q2Q3 -> 2001_Q4")
    assert all(a[4] == b[3] for a, b in zip(more, more[1:]))  # no quarter is left out
    assert sp.history_windows(date(1995, 1, 1), date(1995, 12, 1)) == sp.history_windows(None, None) == []


def test_baseline_predictions_cover_validation_rows(spark):
    t = sp.tag_splits(base(spark, SF), sp.expanding_windows(1999))
    p = md.baseline_predictions(t)
    assert p.count() == t.where(F.col("role") == "val").count()
    assert p.where(F.col("y_pred").isNull()).count() == 0


def test_metric_edge_rules(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.5, 0.5), (-2.0, 1.0), (2e6, 1.0), (10.0, 10.0)], "y_true double, y_pred double")
    r = df.agg(*mt.metric_aggs()).first()
    # masked MAPE skips y=0
    exp = (0 + 3 / 2 + abs((2e6 - 1) / 2e6) + 0) / 4 * 100
    assert abs(r["mape"] - exp) < 1e-9
    zero = spark.createDataFrame([(0.0, 1.0)], "y_true double, y_pred double").agg(*mt.metric_aggs()).first()
    assert zero["mape"] == 100.0
    cats = [x["error_category"] for x in mt.row_errors(df).collect()]
    assert cats[1] == "Excellent (<5%)" and cats[4] == "Excellent (<5%)"


def test_quantiles_are_exact_however_narrow_the_bracket(spark):
    import duckdb
    import numpy as np
    rng = np.random.default_rng(0)
    probs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    columns = {"price": [r[0] for r in base(spark, SF).select("unit_price").collect()],
               "heavy": [float(v) for v in rng.pareto(0.3, 700)] + [0.0] * 90, "two": [1.0] * 5 + [2.0], "one": [3.5],
               "tiny": [float(v) for v in np.nextafter(1e300, np.inf) + np.arange(60) * 1.5e284]}
    for name, v in columns.items():
        df = spark.createDataFrame([(x,) for x in v] + [(None,)], "x double")
        exp = duckdb.sql(f"SELECT quantile_cont(x, {probs}) FROM (SELECT unnest({v}::DOUBLE[]) AS x)").fetchall()[0][0]
        assert quantiles(df, "x", probs) == exp, name
        assert quantiles(df, "x", probs, limit=7, bins=5) == exp, name
    assert quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]
    inf = float("inf")
    far = spark.createDataFrame([(x,) for x in (-inf, -1e308, 0.0, 1e308, inf)], "x double")
    assert quantiles(far, "x", [0.0, 0.25, 0.5, 0.75, 1.0], limit=1, bins=3) == [-inf, -1e308, 0.0, 1e308, inf]


def test_quantile_between_two_narrow_groups_ends(spark):
    import duckdb
    v = [i / 40 for i in range(40)] + [1e6 + i / 40 for i in range(40)]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    exp = duckdb.sql(f"SELECT quantile_cont(x, [0.25, 0.5]) FROM (SELECT unnest({v}::DOUBLE[]) AS x)").fetchall()[0][0]
    assert quantiles(df, "x", [0.25, 0.5], limit=10, bins=8) == exp


def test_quantiles_of_a_fact_column_do_not_group_its_values_first(spark):
    import duckdb
    v = [float(i * i % 997) + i / 7 for i in range(900)]
    probs = [0.0, 0.5, 0.95, 1.0]
    df = spark.createDataFrame([(x,) for x in v] + [(None,), (float("nan"),)], "x double")
    exp = duckdb.sql(f"SELECT quantile_cont(x, {probs}) FROM (SELECT unnest({v}::DOUBLE[]) AS x)").fetchall()[0][0]
    for limit, bins in ((10_000, 4096), (5, 4), (1, 2)):
        assert quantiles(df, "x", probs, limit=limit, bins=bins, fact=True) == exp
    inf = float("inf")
    far = spark.createDataFrame([(x,) for x in (-inf, -1e308, 0.0, 1e308, inf)], "x double")
    assert quantiles(far, "x", [0.0, 0.25, 0.5, 0.75, 1.0], limit=1, bins=3, fact=True) == [-inf, -1e308, 0.0, 1e308, inf]

import math

from pyspark.sql import functions as F

from conftest import fact
from salesplane.functions.exprs import flag, pct_change, r6
from salesplane.operators import clean as cl
from salesplane.operators import temporal as tp

INF = float("inf")


def zero_sales(spark):
    # FIXTURES F7 zero_sales: one entity, q = 3, 0, 0, 7, 9, 4
    qs = [3, 0, 0, 7, 9, 4]
    return fact(spark, [(f"2021-{i + 1:02d}", "P", "S", "B", "x", 10.0 * q, q) for i, q in enumerate(qs)])


def test_pct_change_and_flag(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 0.0), (0.0, 0.0), (-2.0, 0.0), (6.0, 3.0)], "cur double, prev double")
    got = [r[0] for r in df.select(pct_change("cur", "prev")).collect()]
    assert got == [None, INF, None, -INF, 1.0]
    got = [r[0] for r in df.select(flag(F.col("prev") > 1)).collect()]
    assert got == [0, 0, 0, 0, 1]


def test_r6_is_deterministic_rounding(spark):
    df = spark.createDataFrame([(1.23456749,), (-0.0000001,), (2.5e-7,)], "x double")
    got = [r[0] for r in df.select(r6("x")).collect()]
    assert got == [1.234567, 0.0, 0.0] and math.copysign(1, got[1]) == 1


def test_momentum_inf_rules(spark):
    out = tp.momentum_features(zero_sales(spark)).orderBy("sales_month").collect()
    mom = [r["sales_mom_change"] for r in out]
    assert mom[:4] == [0.0, -1.0, 0.0, INF]           # first row 0, 3->0 -1, 0/0 -> 0, 0->7 +inf
    assert abs(mom[4] - 2 / 7) < 1e-12 and abs(mom[5] + 5 / 9) < 1e-12
    assert [r["momentum_up"] for r in out] == [0, 0, 0, 1, 1, 0]
    acc = [r["sales_acceleration"] for r in out]
    assert acc[3] == INF and acc[4] == -INF          # inf - 0, finite - inf
    assert [r["sales_mom_abs_change"] for r in out] == [0.0, -3.0, 0.0, 7.0, 2.0, -5.0]


def test_trend_consistency_needs_three_finite(spark):
    df = tp.advanced_momentum(tp.momentum_features(zero_sales(spark))).orderBy("sales_month")
    rows = df.collect()
    # momentum_2m: [0, 0, -1, inf, inf, -0.555..]; windows with inf are not counted
    assert [r["trend_consistency_3m"] for r in rows] == [0.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_lags_fill_and_rolling_min_periods(spark):
    out = tp.rolling_features(tp.lag_features(cl.add_unit_price(zero_sales(spark)))).orderBy("sales_month").collect()
    assert [r["sales_lag_1"] for r in out] == [0.0, 3.0, 0.0, 0.0, 7.0, 9.0]
    assert out[0]["sales_rolling_std_3"] == 0.0            # single value -> 0
    assert out[0]["sales_rolling_mean_3"] == 3.0
    assert out[3]["sales_rolling_median_3"] == 0.0        # frame (0, 0, 7)
    assert abs(out[5]["sales_rolling_q25_6"] - 0.75) < 1e-12  # sorted 0,0,3,4,7,9 -> pos 1.25


def test_unit_price_median_fill(spark):
    out = cl.add_unit_price(zero_sales(spark)).orderBy("sales_month").collect()
    assert out[1]["unit_price"] == 10.0                      # 0/0 -> median of finite prices


def test_single_row_entity(spark):
    df = fact(spark, [("2021-01", "P", "S", "B", "x", 5.0, 5.0)])
    r = tp.spike_features(df).first()
    assert r["sales_z_score"] is None and r["sales_spike_major"] == 0 and r["sales_drop_moderate"] == 0
    m = tp.momentum_features(df).first()
    assert m["sales_trend_3m"] == 0.0 and m["sales_volatility_3m"] == 0.0


def test_ties_in_month_ordered_by_product(spark):
    df = fact(spark, [("2021-01", "P", "S", "B", "b", 1.0, 1.0), ("2021-01", "P", "S", "B", "a", 2.0, 2.0),
                      ("2021-02", "P", "S", "B", "a", 3.0, 3.0)])
    out = tp.lag_features(cl.add_unit_price(df)).orderBy("sales_month", "product_code").collect()
    assert [r["sales_lag_1"] for r in out] == [0.0, 2.0, 1.0]


def test_fill_missing_values_rules(spark):
    df = spark.createDataFrame([(None, None, None, None, 1), (1.0, 2.0, 4.0, 3.0, None), (None, 4.0, None, None, 0)],
                               "a_ratio double, b_score double, c double, d_index double, flag_x int")
    out = cl.fill_missing_values(df).collect()
    assert out[0]["a_ratio"] == 0.0 and out[0]["b_score"] == 3.0 and out[0]["c"] == 0.0
    assert out[0]["d_index"] == 3.0 and out[1]["flag_x"] == 0


def test_taxonomy_first_match(spark):
    cats = cl.categorize_features(["month_sin", "store_type_flagship", "sales_lag_1", "sales_quantity_log"])
    assert "month_sin" in cats["temporal_basic"] and "store_type_flagship" in cats["customer_behavior"]
    assert cats["lag_features"] == ["sales_lag_1"] and cats["target"] == ["sales_quantity_log"]

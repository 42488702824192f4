from datetime import date

from pyspark.sql import functions as F

from conftest import SF, fact
from salesplane.operators import clean as cl
from salesplane.operators import metrics as mt
from salesplane.operators import model as md
from salesplane.operators import quality as qa
from salesplane.operators import splits as sp
from salesplane.plans.base import base


def test_translate_and_map_platforms(spark):
    df = spark.createDataFrame([("2021-03", "天猫", "店", 1.0), ("2021-04", "TikTok", "x", 2.0), ("2021-05", "Other", "y", 3.0)],
                               "`销售月份` string, `一级平台` string, `店铺名称` string, `销售数量` double")
    t = cl.parse_month(cl.translate_columns(df))
    assert {"sales_month", "primary_platform", "store_name", "sales_quantity"} <= set(t.columns)
    got = [r["primary_platform"] for r in cl.map_platforms(t).orderBy("sales_month").collect()]
    assert got == ["Tmall", "Douyin", "Other"]
    strict = [r["primary_platform"] for r in cl.map_platforms(t, strict=True).orderBy("sales_month").collect()]
    assert strict == ["Tmall", "Douyin", None]
    assert t.orderBy("sales_month").first()["sales_month"] == date(2021, 3, 1)


def test_one_hot_round_trip(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    oh = cl.one_hot(df, "c")
    back = cl.one_hot_to_label(oh, ["c_a", "c_b"], "label", prefix="c_")
    assert [r["label"] for r in back.collect()] == ["a", "b", "a"]


def test_vif_and_random_split(spark):
    b = base(spark, SF)
    v = dict(md.vif(b, ["sales_quantity", "unit_price"]))
    assert all(x >= 1.0 - 1e-9 for x in v.values())
    r = sp.random_split(b)
    share = r.where(F.col("role") == "train").count() / r.count()
    assert 0.75 < share < 0.85
    keys = ["sales_month", "primary_platform", "store_name", "brand_name", "product_code", "role"]
    a = sorted(tuple(x) for x in r.select(*keys).collect())
    c = sorted(tuple(x) for x in sp.random_split(b.repartition(3)).select(*keys).collect())
    assert a == c                                   # role depends on the row key only


def test_rules_and_temporal_integrity(spark):
    s = spark.createDataFrame([(4.0, 1.0), (20.0, 6.0)], "mape_mean double, mape_std double")
    f = mt.sanity_flags(s).collect()
    assert f[0]["suspiciously_low_mape"] == 1 and f[1]["suspiciously_low_mape"] == 0
    assert [r["consistent"] for r in mt.business_ready(s, 10).collect()] == [1, 0]
    df = fact(spark, [("2021-03", "P", "S", "B", "x", 1, 1), ("2021-01", "P", "S", "B", "x", 1, 1),
                      ("2021-06", "P", "S", "B", "x", 1, 1)])
    t = qa.temporal_integrity(df.withColumn("stored", F.col("sales_quantity") + F.month("sales_month") % 3), order_col="stored").first()
    assert t["gap_count"] == 1 and t["out_of_order_rows"] >= 1
    assert "out_of_order_rows" not in qa.temporal_integrity(df).columns


def test_grade_bounds_and_monitoring_rules(spark):
    d = spark.createDataFrame([(15.0, 3.0), (20.0, 3.1), (30.0, 5.0), (40.0, 5.1), (5.0, 0.0), (9.9, 0.0)], "m double, s double")
    m, sd = F.col("m"), F.col("s")
    got = d.select(*[mt.grade(m, r).alias(r) for r in mt.GRADE_RULES], mt.consistency_grade(sd).alias("c"), *mt.health_rules(m, sd)).collect()
    assert [r["trainer"] for r in got] == ["EXCELLENT", "GOOD", "FAIR", "POOR", "EXCELLENT", "EXCELLENT"]
    assert [r["fixed"] for r in got] == ["GOOD", "GOOD", "MODERATE", "POOR", "EXCELLENT", "EXCELLENT"]
    assert [r["notebook"] for r in got] == ["BARELY USABLE", "BARELY USABLE", "POOR", "POOR", "EXCELLENT", "USABLE"]
    assert [r["c"] for r in got][:3] == ["CONSISTENT", "INCONSISTENT", "INCONSISTENT"]
    assert [r["mape_health"] for r in got] == ["reasonable", "reasonable", "reasonable", "high", "suspiciously_low", "suspiciously_low"]
    assert [r["std_health"] for r in got][2:4] == ["consistent", "high_variance"]
    deg = spark.createDataFrame([(15.23,), (16.5,), (17.3,), (30.0,)], "m double").select(mt.degradation(m, 15.23).alias("x")).collect()
    assert [r["x"] for r in deg] == ["stable", "warning", "alert", "alert"]
    ready = mt.business_ready(spark.createDataFrame([(20.0, 5.0), (12.0, 1.0), (26.0, 1.0)], "mape_mean double, mape_std double"), 25, 20).collect()
    assert [r["against_reference"] for r in ready] == ["comparable", "better", "worse"]
    assert [r["business_ready"] for r in ready] == [1, 1, 0] and [r["validation_passed"] for r in ready] == [1, 1, 0]
    log = spark.createDataFrame([(1, 100, 50), (2, 99, 40)], "split_id int, epochs_trained int, best_epoch int")
    e = mt.training_efficiency(log).first()
    assert e["early_stopping_rate"] == 0.5 and e["average_best_epoch"] == 45


def test_monitored_metrics_clip(spark):
    import math
    df = spark.createDataFrame([(math.log1p(9.0), math.log1p(0.0)), (math.log1p(2e6), math.log1p(1e6))], "y double, p double")
    r = df.agg(*mt.monitored_metrics(F.col("y"), F.col("p"))).first()
    # row 1: y=9, p=0 -> clipped to 1 -> |9-1| / (9 + 1); row 2: both clip to 1e6 -> 0
    assert abs(r["monitored_mape"] - (8 / 10 * 100) / 2) < 1e-6

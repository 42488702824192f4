from pyspark.sql import functions as F

from conftest import fact
from salesplane.operators import behaviour as bh
from salesplane.operators import clean as cl
from salesplane.operators import platforms as pf
from salesplane.operators import stores as st

NAMES = ["茅台官方旗舰店", "天猫超市", "酒类专营店", "京东自营", "进口酒海外店", "无名", None]


def names_frame(spark):
    return fact(spark, [("2021-01", "JD" if n and "京东" in n else "Tmall", n, "B", "x", 1.0, 1.0) for n in NAMES])


def test_store_types_weighted_keywords(spark):
    got = {r["store_name"]: (r["store_type"], r["store_type_score"]) for r in st.store_types(names_frame(spark)).collect()}
    assert got["茅台官方旗舰店"] == ("flagship", 1.0)       # 2 flagship hits beat 1 official hit
    assert got["天猫超市"] == ("supermarket", 0.8)
    assert got["酒类专营店"][0] == "specialty"
    assert got["京东自营"][0] == "third_party"           # no keyword of any type occurs
    assert got["进口酒海外店"][0] == "cross_border"        # 0.4*2 beats third_party 0.3*1
    assert got["无名"] == ("third_party", 0.3) and got[None] == ("third_party", 0.3)


def test_store_type_v1_order(spark):
    got = {r["store_name"]: r["store_type_v1"] for r in st.store_type_v1(names_frame(spark)).collect()}
    assert got["茅台官方旗舰店"] == "Official Flagship" and got["京东自营"] == "Platform Direct"
    assert got["天猫超市"] == "Supermarket" and got["无名"] == "Other" and got[None] == "Unknown"


def test_platform_flags_only_on_own_platform(spark):
    out = {(r["primary_platform"], r["store_name"]): r for r in st.platform_store_flags(names_frame(spark)).collect()}
    assert out[("Tmall", "天猫超市")]["tmall_flagship_store"] == 1
    assert out[("JD", "京东自营")]["jd_official_store"] == 1 and out[("JD", "京东自营")]["tmall_official_store"] == 0


def test_argmax_tie_by_name_and_shares_sum_to_one(spark):
    df = fact(spark, [("2021-01", "B", "S", "x", "1", 1, 5), ("2021-01", "A", "S", "x", "1", 1, 5),
                      ("2021-01", "C", "T", "x", "1", 1, 2)])
    mp = {r["store_name"]: r["dominant_platform"] for r in st.multi_platform(df).collect()}
    assert mp == {"S": "A", "T": "C"}
    b = cl.add_unit_price(df)
    s = bh.store_share_in_platform(b).groupBy("primary_platform").agg(F.sum("store_platform_market_share").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-12 for r in s.collect())


def test_constant_metric_minmax(spark):
    df = cl.add_unit_price(fact(spark, [(m, "P", f"S{i}", "B", "x", 4.0, 2.0) for i in range(4)
                                        for m in ("2021-01", "2021-02")]))
    q = st.store_quality(df).collect()
    assert all(abs(r["store_quality_score"] - 0.3) < 1e-9 for r in q)   # only the inverted term survives


def test_fallback_when_no_multi_platform_store(spark):
    df = cl.add_unit_price(fact(spark, [("2021-01", "P", "S", "B", "x", 1, 1), ("2021-02", "P", "T", "B", "x", 1, 3)]))
    rows = pf.platform_preference(df).collect()
    assert all(r["preferred_platform"] == "P" and r["on_preferred_platform"] == 1 for r in rows)


def test_join_back_keeps_row_count(spark):
    df = cl.add_unit_price(fact(spark, [("2021-01", "P", "S", "B", str(i), 1, i + 1) for i in range(5)]))
    out = bh.join_back(df, bh.store_behaviour(df), ["primary_platform", "store_name"])
    assert out.count() == 5
    out = bh.attach(df, [bh.loyalty(df), bh.performance_categories(df)], ["primary_platform", "store_name", "brand_name"])
    assert out.count() == 5

"""Store classification and store-level positioning.

Name rules run on the *distinct store table* (one row per store name) and are
joined back; the keyword tables are arguments so other vocabularies can be used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import contains_any, count_hits, flag
from ..functions.stats import quantiles
from . import dims

STORE = ["primary_platform", "store_name"]


def store_types(df: DataFrame, keywords=K.STORE_TYPE_KEYWORDS, default=K.STORE_TYPE_DEFAULT) -> DataFrame:
    """Weighted keyword score per type, argmax (ties -> declared order), no hit -> default."""
    stores = df.select("store_name").distinct()
    name = F.col("store_name")
    scores = F.array(*[count_hits(name, kws) * F.lit(w) for _, w, kws in keywords])
    best = F.array_max(scores)
    pos = F.array_position(scores, best)  # first position holding the max = declared order
    types = F.array(*[F.lit(t) for t, _, _ in keywords])
    weights = F.array(*[F.lit(float(w)) for _, w, _ in keywords])
    t = stores.select("store_name", F.when(best > 0, F.element_at(types, pos.cast("int")))
                      .otherwise(F.lit(default)).alias("store_type"))
    onehot = [flag(F.col("store_type") == ty).alias(f"store_type_{ty}") for ty, _, _ in keywords]
    score = F.element_at(weights, F.array_position(types, F.col("store_type")).cast("int"))
    return t.select("store_name", "store_type", *onehot, score.alias("store_type_score"))


def platform_store_flags(df: DataFrame, indicators=K.PLATFORM_INDICATORS, platforms=None) -> DataFrame:
    """<platform>_flagship_store / _official_store (case-insensitive, only on that platform).

    Works on the distinct (platform, store) table.  ``platforms`` limits the
    generated columns (default: the platforms present that have indicators).
    """
    t = df.select(*STORE).distinct()
    if platforms is None:
        present = {r[0] for r in t.select("primary_platform").distinct().collect()}
        platforms = [p for p, _, _ in indicators if p in present]
    cols = []
    for p, flagship, official in indicators:
        if p not in platforms:
            continue
        on = F.col("primary_platform") == p
        name = F.coalesce(F.col("store_name"), F.lit(""))
        cols.append(flag(on & contains_any(name, flagship)).alias(f"{p.lower()}_flagship_store"))
        cols.append(flag(on & contains_any(name, official)).alias(f"{p.lower()}_official_store"))
    return t.select(*STORE, *cols)


def store_type_v1(df: DataFrame, rules=K.STORE_TYPE_RULES_V1) -> DataFrame:
    """Ordered substring rules on the store name; NULL -> Unknown; one-hot."""
    name = F.col("store_name")
    label = F.lit(K.STORE_TYPE_V1_OTHER)
    for subs, lab in reversed(rules):
        label = F.when(contains_any(name, subs, lower=False), F.lit(lab)).otherwise(label)
    label = F.when(name.isNull(), F.lit(K.STORE_TYPE_V1_NULL)).otherwise(label)
    labels = [lab for _, lab in rules] + [K.STORE_TYPE_V1_OTHER, K.STORE_TYPE_V1_NULL]
    t = df.select("store_name").distinct().select("store_name", label.alias("store_type_v1"))
    return t.select("*", *[flag(F.col("store_type_v1") == lab).alias("store_type_v1_" + lab.lower().replace(" ", "_"))
                           for lab in labels])


def argmax_key(table: DataFrame, group, key: str, value: str, out: str) -> DataFrame:
    """Per ``group``, the ``key`` with the largest ``value``; ties -> smallest key."""
    best = F.min_by(F.col(key), F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    return table.groupBy(*group).agg(best.alias(out))


def multi_platform(df: DataFrame) -> DataFrame:
    """A11 + A12: platforms per store, and the store's dominant platform by quantity."""
    sp = df.groupBy("store_name", "primary_platform").agg(F.sum("sales_quantity").alias("q"))
    cnt = sp.groupBy("store_name").agg(F.count("*").alias("store_multi_platform"))
    dom = argmax_key(sp, ["store_name"], "primary_platform", "q", "dominant_platform")
    return cnt.join(dom, "store_name").select(
        "store_name", "store_multi_platform",
        flag(F.col("store_multi_platform") > 1).alias("store_multi_platform_binary"), "dominant_platform")


def _minmax(c, lo, hi, invert=False):
    x = (F.col(c) - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + 1e-6)
    return (1 - x) if invert else x


def store_quality(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Consistency / diversity / longevity / volume scores, tiers and trust."""
    s = stats if stats is not None else dims.store_stats(df)
    t = s.select(*STORE, (F.col("q_std") / (F.col("q_mean") + 1)).alias("quality_consistency"),
                 (F.col("n_brand") * F.col("n_product")).cast("double").alias("quality_diversity"),
                 F.col("n_month").cast("double").alias("quality_longevity"),
                 F.col("q_sum").alias("quality_volume"))
    mets = ["quality_consistency", "quality_diversity", "quality_longevity", "quality_volume"]
    mm = t.agg(*[F.min(c).alias(f"mn_{c}") for c in mets], *[F.max(c).alias(f"mx_{c}") for c in mets]).first()
    score = (_minmax("quality_consistency", mm["mn_quality_consistency"], mm["mx_quality_consistency"], True) * 0.3
             + _minmax("quality_diversity", mm["mn_quality_diversity"], mm["mx_quality_diversity"]) * 0.2
             + _minmax("quality_longevity", mm["mn_quality_longevity"], mm["mx_quality_longevity"]) * 0.2
             + _minmax("quality_volume", mm["mn_quality_volume"], mm["mx_quality_volume"]) * 0.3)
    t = t.select(*STORE, score.alias("store_quality_score")).persist()
    q33, q67 = quantiles(t, "store_quality_score", [0.33, 0.67])
    s = F.col("store_quality_score")
    return t.select("*", flag(s > F.lit(q67)).alias("store_quality_high"),
                    flag((s > F.lit(q33)) & (s <= F.lit(q67))).alias("store_quality_medium"),
                    flag(s <= F.lit(q33)).alias("store_quality_low"),
                    flag(s > 0.7).alias("store_trust_high"))


def trust_verified(types: DataFrame) -> DataFrame:
    """Flagship or official or supermarket (on the store-type table)."""
    return types.select("store_name", flag((F.col("store_type_flagship") + F.col("store_type_official")
                                            + F.col("store_type_supermarket")) > 0).alias("store_trust_verified"))


def business_model(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Brand breadth, volume and price position per (platform, store)."""
    s = stats if stats is not None else dims.store_stats(df)
    t = s.select(*STORE, F.col("n_brand").alias("bm_brand_count"), F.col("p_mean").alias("bm_price_mean"),
                 F.col("p_std").alias("bm_price_std"), F.col("q_sum").alias("bm_sales_total"))
    (v80,) = quantiles(t, "bm_sales_total", [0.8])
    p20, p80 = quantiles(t, "bm_price_mean", [0.2, 0.8])
    b = F.col("bm_brand_count")
    cv = F.col("bm_price_std") / (F.col("bm_price_mean") + 1)
    return t.select(*STORE, flag(b >= 5).alias("bm_multi_brand_retailer"),
                    flag(b == 1).alias("bm_single_brand_specialist"),
                    flag((b >= 2) & (b <= 4)).alias("bm_limited_brand_specialist"),
                    flag(F.col("bm_sales_total") > F.lit(v80)).alias("bm_high_volume_retailer"),
                    flag(F.col("bm_price_mean") > F.lit(p80)).alias("bm_premium_retailer"),
                    flag(F.col("bm_price_mean") < F.lit(p20)).alias("bm_budget_retailer"),
                    flag(cv < 0.3).alias("bm_consistent_pricing"), flag(cv > 0.7).alias("bm_diverse_pricing"))


def competition(df: DataFrame) -> DataFrame:
    """Competing stores per (platform, brand)."""
    t = df.groupBy("primary_platform", "brand_name").agg(
        F.count_distinct("store_name").alias("competing_stores"),
        F.sum("sales_quantity").alias("total_brand_sales"))
    c = F.col("competing_stores")
    return t.select("*", flag(c <= 2).alias("competition_low"), flag((c > 2) & (c <= 5)).alias("competition_medium"),
                    flag(c > 5).alias("competition_high"))


def _share_flags(share, prefix, names=("leader", "major", "minor", "niche")):
    return [flag(share > 0.5).alias(f"{prefix}_{names[0]}"),
            flag((share > 0.2) & (share <= 0.5)).alias(f"{prefix}_{names[1]}"),
            flag((share > 0.05) & (share <= 0.2)).alias(f"{prefix}_{names[2]}"),
            flag(share <= 0.05).alias(f"{prefix}_{names[3]}")]


def store_share_in_brand(df: DataFrame) -> DataFrame:
    """Store share inside (platform, brand)."""
    t = df.groupBy("primary_platform", "brand_name", "store_name").agg(
        F.sum("sales_quantity").alias("store_brand_sales"))
    tot = F.sum("store_brand_sales").over(Window.partitionBy("primary_platform", "brand_name"))
    t = t.withColumn("store_brand_share", F.try_divide(F.col("store_brand_sales"), tot))
    return t.select("*", *_share_flags(F.col("store_brand_share"), "competitive"))


def platform_ranks(df: DataFrame, platforms=None) -> DataFrame:
    """Dense rank of store totals inside each platform, top 10 / top 50, one
    column group per platform (0 for rows of other platforms)."""
    t = df.groupBy(*STORE).agg(F.sum("sales_quantity").alias("platform_sales_total"))
    t = t.withColumn("_rank", F.dense_rank().over(
        Window.partitionBy("primary_platform").orderBy(F.desc("platform_sales_total"))))
    if platforms is None:
        platforms = sorted(r[0] for r in t.select("primary_platform").distinct().collect())
    cols = []
    for p in platforms:
        on = F.col("primary_platform") == p
        r = F.when(on, F.col("_rank")).otherwise(F.lit(0))  # other platforms: 0, as after the final fill
        n = p.lower()
        cols += [r.alias(f"{n}_sales_rank"), flag(on & (F.col("_rank") <= 10)).alias(f"{n}_top_10_store"),
                 flag(on & (F.col("_rank") <= 50)).alias(f"{n}_top_50_store")]
    return t.select(*STORE, *cols)


def store_behaviour_v1(df: DataFrame) -> DataFrame:
    """v1 store profile per (store, platform): cv, range, revenue per unit,
    diversity, price premium, quintile size label on count*mean."""
    t = df.groupBy("store_name", "primary_platform").agg(
        F.avg("sales_quantity").alias("m"), F.stddev_samp("sales_quantity").alias("s"),
        F.count("sales_quantity").alias("n"), F.min("sales_quantity").alias("lo"),
        F.max("sales_quantity").alias("hi"), F.sum("sales_amount").alias("amt"),
        F.sum("sales_quantity").alias("qty"), F.count_distinct("brand_name").alias("store_brand_diversity"),
        F.count_distinct("product_code").alias("store_product_diversity"), F.avg("unit_price").alias("store_avg_price"))
    gm = t.agg(F.avg("store_avg_price")).first()[0]
    t = t.select("store_name", "primary_platform",
                 F.coalesce(F.try_divide(F.col("s"), F.col("m")), F.lit(0.0)).alias("store_sales_cv_v1"),
                 (F.col("hi") - F.col("lo")).alias("store_sales_range_v1"),
                 F.try_divide(F.col("amt"), F.col("qty")).alias("store_revenue_per_unit"),
                 "store_brand_diversity", "store_product_diversity",
                 F.try_divide(F.col("store_avg_price"), F.lit(gm)).alias("store_price_premium"),
                 (F.col("n") * F.col("m")).alias("store_size_metric"))
    edges = quantiles(t, "store_size_metric", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])
    uniq = sorted(set(edges))
    labels = ["Micro", "Small", "Medium", "Large", "Mega"][:max(len(uniq) - 1, 0)]
    x = F.col("store_size_metric")
    lab = F.lit(None).cast("string")
    for i in range(len(uniq) - 1, 0, -1):  # right-closed bins, first bin includes its left edge
        lo, hi = uniq[i - 1], uniq[i]
        cond = (x <= F.lit(hi)) & ((x > F.lit(lo)) if i > 1 else (x >= F.lit(lo)))
        lab = F.when(cond, F.lit(labels[i - 1])).otherwise(lab)
    return t.withColumn("store_size_category", lab)


def store_type_index(df: DataFrame, type_col="store_type_v1") -> DataFrame:
    """Per store type, mean quantity and mean price relative to the global means."""
    g = df.agg(F.avg("sales_quantity").alias("gq"), F.avg("unit_price").alias("gp")).first()
    return df.groupBy(type_col).agg(
        F.try_divide(F.avg("sales_quantity"), F.lit(g["gq"])).alias("store_type_sales_index"),
        F.try_divide(F.avg("unit_price"), F.lit(g["gp"])).alias("store_type_price_index"))

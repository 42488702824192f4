"""Cross-platform dynamics (A18-A32) and v1 platform / brand blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import cents_sum, flag
from .stores import _share_flags, argmax_key

ENTITY = ["primary_platform", "store_name", "brand_name"]


def brand_presence(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Per brand (``brand_platform_count`` also exposed as the _x/_y aliases)."""
    from . import dims
    s = stats if stats is not None else dims.brand_stats(df)
    t = s.select("brand_name", F.col("n_platform").alias("brand_platform_count"),
                 F.col("n_store").alias("brand_total_stores"), F.col("q_sum").alias("brand_cross_platform_sales"),
                 F.col("a_sum").alias("brand_cross_platform_amount"))
    n = F.col("brand_platform_count")
    return t.select("*", flag(n > 1).alias("brand_multi_platform"), flag(n == 1).alias("brand_platform_exclusive"),
                    flag(n >= 3).alias("brand_omnichannel"))


def store_presence(df: DataFrame) -> DataFrame:
    """Per store."""
    t = df.groupBy("store_name").agg(
        F.count_distinct("primary_platform").alias("store_platform_count"),
        F.count_distinct("brand_name").alias("store_brand_count_cross"),
        F.sum("sales_quantity").alias("store_cross_platform_sales"))
    return t.withColumn("store_multi_platform_seller", flag(F.col("store_platform_count") > 1))


def competing_platforms(df: DataFrame) -> DataFrame:
    """Platforms per (brand, store)."""
    t = df.groupBy("brand_name", "store_name").agg(F.count_distinct("primary_platform").alias("competing_platforms"))
    return t.withColumn("cross_platform_competition", flag(F.col("competing_platforms") > 1))


def platform_preference(df: DataFrame) -> DataFrame:
    """A21-A23 per (store, platform): preferred platform of multi-platform stores,
    performance ratio to the store's best platform, whole-table fallback."""
    sp = df.groupBy("store_name", "primary_platform").agg(F.sum("sales_quantity").alias("mp_sales_total"))
    w = Window.partitionBy("store_name")
    sp = sp.withColumn("_np", F.count("*").over(w)).withColumn("_mx", F.max("mp_sales_total").over(w)).persist()
    multi = sp.where(F.col("_np") > 1)
    pref = argmax_key(multi, ["store_name"], "primary_platform", "mp_sales_total", "preferred_platform")
    t = sp.join(pref, "store_name", "left")
    ratio = F.when(F.col("_np") > 1, F.try_divide(F.col("mp_sales_total"), F.col("_mx"))).otherwise(F.lit(1.0))
    t = t.select("store_name", "primary_platform", "preferred_platform",
                 flag(F.col("primary_platform") == F.col("preferred_platform")).alias("on_preferred_platform"),
                 ratio.alias("platform_performance_ratio"))
    has_multi = sp.agg(F.max("_np")).first()[0] > 1  # one scalar decides A23
    if not has_multi:  # A23
        t = t.select("store_name", "primary_platform", F.col("primary_platform").alias("preferred_platform"),
                     F.lit(1).alias("on_preferred_platform"), F.lit(1.0).alias("platform_performance_ratio"))
    r = F.col("platform_performance_ratio")
    return t.select("*", flag(r > 0.8).alias("platform_dominant_performance"),
                    flag((r >= 0.4) & (r <= 0.8)).alias("platform_balanced_performance"),
                    flag(r < 0.4).alias("platform_weak_performance"))


def platform_loyalty(df: DataFrame) -> DataFrame:
    """Per (store, brand): platforms used, first / last platform by month (ties by name)."""
    key = F.struct(F.col("sales_month"), F.col("primary_platform"))
    t = df.groupBy("store_name", "brand_name").agg(
        F.count_distinct("primary_platform").alias("platform_switches"),
        F.min_by("primary_platform", key).alias("first_platform"),
        F.max_by("primary_platform", key).alias("last_platform"))
    n = F.col("platform_switches")
    return t.select("store_name", "brand_name", flag(n == 1).alias("platform_loyal"),
                    flag(n > 1).alias("platform_switcher"),
                    flag(F.col("first_platform") == F.col("last_platform")).alias("platform_stable"))


def platform_tenure(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """A25 (per fact row): months since the entity's first month."""
    from .temporal import with_group_stats
    df = with_group_stats(df, ENTITY, [F.min("sales_month").alias("_entry_month")], source)
    ten = F.round(F.datediff(F.col("sales_month"), F.col("_entry_month")) / K.DAYS_PER_MONTH).cast("int")
    df = df.withColumn("platform_tenure_months", ten).drop("_entry_month")
    t = F.col("platform_tenure_months")
    return df.select("*", flag(t <= 3).alias("platform_newcomer"), flag((t > 3) & (t <= 12)).alias("platform_experienced"),
                     flag(t > 12).alias("platform_veteran"))


def platform_seasonal_index(df: DataFrame) -> DataFrame:
    """Per (platform, calendar month), month mean / platform mean."""
    pm = df.groupBy("primary_platform", F.month("sales_month").alias("month")).agg(
        F.avg("sales_quantity").alias("platform_month_avg_sales"),
        F.sum("sales_quantity").alias("platform_month_total_sales"))
    pa = df.groupBy("primary_platform").agg(F.avg("sales_quantity").alias("platform_annual_avg"))
    t = pm.join(F.broadcast(pa), "primary_platform")  # one row per platform
    idx = F.try_divide(F.col("platform_month_avg_sales"), F.col("platform_annual_avg"))
    return t.select("primary_platform", "month", idx.alias("platform_seasonal_index"),
                    flag(idx > 1.2).alias("platform_peak_season"),
                    flag((idx >= 0.8) & (idx <= 1.2)).alias("platform_normal_season"),
                    flag(idx < 0.8).alias("platform_low_season"))


def platform_promo_lift(df: DataFrame, promo_col="is_promotional_period") -> DataFrame:
    """mean(promo) / mean(non-promo) - 1 per platform; missing side -> 0."""
    t = df.groupBy("primary_platform").agg(
        F.avg(F.when(F.col(promo_col) == 1, F.col("sales_quantity"))).alias("promo_sales"),
        F.avg(F.when(F.col(promo_col) == 0, F.col("sales_quantity"))).alias("baseline_sales"))
    lift = F.coalesce(F.try_divide(F.col("promo_sales"), F.col("baseline_sales")) - 1, F.lit(0.0))
    t = t.select("primary_platform", lift.alias("platform_promo_lift"))
    x = F.col("platform_promo_lift")
    return t.select("*", flag(x > 0.5).alias("platform_promo_highly_responsive"),
                    flag((x > 0.2) & (x <= 0.5)).alias("platform_promo_moderately_responsive"),
                    flag(x <= 0.2).alias("platform_promo_low_responsive"))


def brand_platform_landscape(df: DataFrame) -> DataFrame:
    """Per (brand, platform)."""
    t = df.groupBy("brand_name", "primary_platform").agg(
        F.count_distinct("store_name").alias("brand_platform_competitor_count"),
        F.sum("sales_quantity").alias("brand_platform_total_sales"),
        cents_sum("sales_amount").alias("brand_platform_total_amount"))
    n = F.col("brand_platform_competitor_count")
    return t.select("*", flag(n == 1).alias("brand_platform_monopoly"),
                    flag((n >= 2) & (n <= 5)).alias("brand_platform_oligopoly"),
                    flag(n > 5).alias("brand_platform_competitive"))


def store_rank_in_brand_platform(df: DataFrame) -> DataFrame:
    """Per (brand, platform, store): sales, share, dense rank and flags."""
    t = df.groupBy("brand_name", "primary_platform", "store_name").agg(F.sum("sales_quantity").alias("store_bp_sales"))
    w = Window.partitionBy("brand_name", "primary_platform")
    t = t.select("*", F.try_divide(F.col("store_bp_sales"), F.sum("store_bp_sales").over(w)).alias("store_bp_market_share"),
                 F.dense_rank().over(w.orderBy(F.desc("store_bp_sales"))).alias("store_bp_rank"))
    r, s = F.col("store_bp_rank"), F.col("store_bp_market_share")
    return t.select("*", flag(r == 1).alias("store_bp_leader"), flag(r <= 3).alias("store_bp_top_3"),
                    flag(r <= 10).alias("store_bp_top_10"),
                    *_share_flags(s, "store_bp", ("dominant", "major", "minor", "niche")))


def best_platform(df: DataFrame) -> DataFrame:
    """Per (store, platform): the store's platform with the highest mean quantity."""
    sp = df.groupBy("store_name", "primary_platform").agg(F.avg("sales_quantity").alias("m"))
    n_platforms = sp.select("primary_platform").distinct().count()
    if n_platforms > 1:
        best = argmax_key(sp, ["store_name"], "primary_platform", "m", "best_platform")
        t = sp.join(best, "store_name")
    else:
        t = sp.withColumn("best_platform", F.col("primary_platform"))
    return t.select("store_name", "primary_platform", "best_platform",
                    flag(F.col("primary_platform") == F.col("best_platform")).alias("on_best_platform"))


def specialization(df: DataFrame) -> DataFrame:
    """Per store, one platform = specialisation, more than two = diversification."""
    t = df.groupBy("store_name").agg(F.count_distinct("primary_platform").alias("n"))
    return t.select("store_name", flag(F.col("n") == 1).alias("store_specialization_strategy"),
                    flag(F.col("n") > 2).alias("store_diversification_strategy"))


def entry_timing(tenured: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """A32 (per fact row, needs A25): platform q25 / q75 of tenure over fact rows.

    ``percentile`` per platform keeps one value->count map per platform; tenure
    is a small integer (months), so the map is bounded by the history length.
    """
    q = (source if source is not None else tenured).groupBy("primary_platform").agg(
        F.percentile("platform_tenure_months", 0.25).alias("tenure_q25"),
        F.percentile("platform_tenure_months", 0.75).alias("tenure_q75"))
    t = tenured.join(F.broadcast(q), "primary_platform", "left")
    x = F.col("platform_tenure_months")
    return t.select("*", flag(x >= F.col("tenure_q75")).alias("platform_early_mover"),
                    flag(x <= F.col("tenure_q25")).alias("platform_late_entrant"),
                    flag((x > F.col("tenure_q25")) & (x < F.col("tenure_q75"))).alias("platform_mid_entrant")
                    ).drop("tenure_q25", "tenure_q75")


# ------------------------------------------------------------------- v1 ------

def monthly_platform_competition(df: DataFrame) -> DataFrame:
    """Per (month, platform)."""
    return df.groupBy("sales_month", "primary_platform").agg(
        F.count_distinct("brand_name").alias("monthly_brand_count"),
        F.count_distinct("store_name").alias("monthly_store_count"),
        F.sum("sales_quantity").alias("monthly_platform_sales"),
        F.avg("sales_quantity").alias("monthly_platform_avg"),
        F.count("sales_quantity").alias("monthly_platform_records"))


def brand_platform_preference(df: DataFrame) -> DataFrame:
    """Per (brand, platform): multi-platform flag and mean(platform)/mean(all) (1.0 if single)."""
    b = df.groupBy("brand_name").agg(F.count_distinct("primary_platform").alias("np"),
                                     F.avg("sales_quantity").alias("ball"))
    bp = df.groupBy("brand_name", "primary_platform").agg(F.avg("sales_quantity").alias("bpm"))
    t = bp.join(b, "brand_name")
    return t.select("brand_name", "primary_platform", flag(F.col("np") > 1).alias("is_multi_platform_brand"),
                    F.when(F.col("np") > 1, F.try_divide(F.col("bpm"), F.col("ball"))).otherwise(1.0)
                    .alias("platform_preference_score"))


def learned_monthly_intensity(df: DataFrame) -> DataFrame:
    """Per calendar month, mean / overall mean."""
    overall = df.agg(F.avg("sales_quantity")).first()[0]
    return df.groupBy(F.month("sales_month").alias("month")).agg(
        F.try_divide(F.avg("sales_quantity"), F.lit(overall)).alias("monthly_intensity_learned"))


def brand_seasonal_index(df: DataFrame) -> DataFrame:
    """Per (brand, calendar month), mean / brand mean."""
    w = Window.partitionBy("brand_name")
    t = df.groupBy("brand_name", F.month("sales_month").alias("month")).agg(
        F.sum("sales_quantity").alias("s"), F.count("sales_quantity").alias("n"))
    brand_mean = F.sum("s").over(w) / F.sum("n").over(w)
    return t.select("brand_name", "month", F.try_divide(F.col("s") / F.col("n"), brand_mean).alias("brand_seasonal_index"))


def brand_promo_effectiveness(df: DataFrame, promo_col="is_promo_month") -> DataFrame:
    """Per brand, mean(promo)/mean(non-promo), missing -> 1."""
    t = df.groupBy("brand_name").agg(
        F.avg(F.when(F.col(promo_col) == 1, F.col("sales_quantity"))).alias("p"),
        F.avg(F.when(F.col(promo_col) == 0, F.col("sales_quantity"))).alias("n"))
    return t.select("brand_name", F.coalesce(F.try_divide(F.col("p"), F.col("n")), F.lit(1.0))
                    .alias("brand_promo_effectiveness"))


def yoy_growth_potential(df: DataFrame, target_year: int) -> DataFrame:
    """A42 (per fact row): in ``target_year``, months 4-12: q / entity-month mean, else 1."""
    from .temporal import with_group_stats
    df = with_group_stats(df.withColumn("_moy", F.month("sales_month")), [*ENTITY, "_moy"],
                          [F.avg("sales_quantity").alias("_em_mean")])
    ratio = F.try_divide(F.col("sales_quantity"), F.col("_em_mean"))
    m = F.col("_moy")
    return df.withColumn("yoy_growth_potential",
                         F.when((F.year("sales_month") == target_year) & (m >= 4) & (m <= 12), ratio)
                         .otherwise(F.lit(1.0))).drop("_moy", "_em_mean")


def top_brand_flag(df: DataFrame, k: int = 5) -> DataFrame:
    """Brand in the top k by row count (ties by name) as a membership flag
    (broadcast left join of the k-row key set); one row per brand."""
    counts = df.groupBy("brand_name").count()
    top = counts.orderBy(F.desc("count"), F.asc("brand_name")).limit(k).select("brand_name", F.lit(1).alias("_t"))
    return counts.join(F.broadcast(top), "brand_name", "left").select(
        "brand_name", F.coalesce(F.col("_t"), F.lit(0)).alias("is_top_brand"))

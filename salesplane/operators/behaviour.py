"""Dimension aggregates joined back to the fact (A1-A10) and the join-back helper.

Each block returns its *aggregate table* (one row per group); ``join_back``
attaches it to the fact with a left equi-join.  Threshold quantiles are taken
over the aggregate table (one row per group), never over fact rows.  Platform-
level tables have one row per platform (bounded) and are broadcast; larger
aggregates are left to AQE, which broadcasts them only when runtime statistics
put them under the broadcast threshold and otherwise shuffles both sides on
the key (and splits skewed key partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import cents_sum, flag, safe_div
from ..functions.stats import quantiles
from . import dims, wide

ENTITY = ["primary_platform", "store_name", "brand_name"]
STORE = ["primary_platform", "store_name"]


def join_back(df: DataFrame, table: DataFrame, keys, broadcast: bool = False) -> DataFrame:
    """Left equi-join of an aggregate (or a small lookup table: the Spark form
    of a dictionary map) back to the fact; colliding columns keep the fact's."""
    keys, own = list(keys), wide.names(df)
    extra = [c for c in table.columns if c not in keys and c in own]
    t = table.drop(*extra)
    out = df.join(F.broadcast(t) if broadcast else t, on=keys, how="left")
    return wide.ordered(out, [*keys, *(c for c in own if c not in keys)])


DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def attach(df: DataFrame, tables, keys, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Join several aggregate tables that share one key to the fact with a single join.

    The tables are first joined to each other (all are small: one row per key),
    persisted, and counted; the combined table is broadcast only when its
    counted size (rows x columns x 8 bytes + row overhead) is under the limit,
    otherwise both sides are shuffled on the key (and AQE splits skewed keys).
    """
    t, small = combined(tables, keys, max_broadcast_bytes)
    return join_back(df, t, keys, broadcast=small)


def combined(tables, keys, max_broadcast_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """The tables of ``attach`` as one, persisted, and whether it is small enough to be broadcast."""
    from functools import reduce
    keys = list(keys)
    t = reduce(lambda a, b: a.join(b.drop(*[c for c in b.columns if c in a.columns and c not in keys]),
                                   keys, "full"), tables).persist()
    n = t.count()
    limit = DEFAULT_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    est = n * (8 * len(t.columns) + 48)
    return t, est <= limit


def _tiers(c, q_lo, q_hi, names):
    """<= q_lo, (q_lo, q_hi], > q_hi  -> three flags."""
    x = F.col(c)
    lo, hi = F.lit(q_lo), F.lit(q_hi)
    return [flag(x <= lo).alias(names[0]), flag((x > lo) & (x <= hi)).alias(names[1]),
            flag(x > hi).alias(names[2])]


def store_behaviour(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """A1: per (platform, store)."""
    s = stats if stats is not None else dims.store_stats(df)
    t = s.select(*STORE, F.col("q_mean").alias("store_sales_mean"), F.col("q_std").alias("store_sales_std"),
                 F.col("q_min").alias("store_sales_min"), F.col("q_max").alias("store_sales_max"),
                 F.col("q_n").alias("store_record_count"), F.col("a_mean").alias("store_amount_mean"),
                 F.col("a_std").alias("store_amount_std"), F.col("p_mean").alias("store_price_mean"),
                 F.col("p_std").alias("store_price_std"), F.col("n_brand").alias("store_brand_count"),
                 F.col("n_product").alias("store_product_count"))
    t = t.select("*",
                 (F.col("store_sales_std") / (F.col("store_sales_mean") + 1)).alias("store_sales_cv"),
                 (F.col("store_sales_max") - F.col("store_sales_min")).alias("store_sales_range"),
                 (F.col("store_price_std") / (F.col("store_price_mean") + 1)).alias("store_price_cv"))
    cv = F.col("store_sales_cv")
    q33, q67 = quantiles(t, "store_sales_mean", [0.33, 0.67])
    return t.select("*", flag(cv < 0.5).alias("store_consistency_high"),
                    flag((cv >= 0.5) & (cv < 1.0)).alias("store_consistency_medium"),
                    flag(cv >= 1.0).alias("store_consistency_low"),
                    *_tiers("store_sales_mean", q33, q67,
                            ["store_size_small", "store_size_medium", "store_size_large"]))


def brand_analysis(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """A2: per brand, shares of the whole market, diversity, price and sales tiers."""
    tot = df.agg(F.sum("sales_quantity").alias("tq"), cents_sum("sales_amount").alias("ta"),
                 F.count_distinct("store_name").alias("ns"),
                 F.count_distinct("primary_platform").alias("np"),
                 F.avg("unit_price").alias("mp")).first()
    s = stats if stats is not None else dims.brand_stats(df)
    t = s.select("brand_name", F.col("q_mean").alias("brand_sales_mean"), F.col("q_std").alias("brand_sales_std"),
                 F.col("q_sum").alias("brand_sales_total"), F.col("a_mean").alias("brand_amount_mean"),
                 F.col("a_sum").alias("brand_amount_total"), F.col("p_mean").alias("brand_price_mean"),
                 F.col("p_std").alias("brand_price_std"), F.col("n_store").alias("brand_store_count"),
                 F.col("n_platform").alias("brand_platform_count"), F.col("n_product").alias("brand_product_count"))
    p = F.col("brand_price_mean")
    t = t.select("*",
                 safe_div(F.col("brand_sales_total"), F.lit(tot["tq"])).alias("brand_market_share_quantity"),
                 safe_div(F.col("brand_amount_total"), F.lit(tot["ta"])).alias("brand_market_share_amount"),
                 safe_div(F.col("brand_store_count"), F.lit(tot["ns"])).alias("brand_diversity_stores"),
                 safe_div(F.col("brand_platform_count"), F.lit(tot["np"])).alias("brand_diversity_platforms"),
                 flag(p > F.lit(tot["mp"] * 1.2)).alias("brand_premium_indicator"),
                 flag(p < F.lit(tot["mp"] * 0.8)).alias("brand_budget_indicator"),
                 flag((p >= F.lit(tot["mp"] * 0.8)) & (p <= F.lit(tot["mp"] * 1.2))).alias("brand_mid_range_indicator"))
    q25, q75 = quantiles(t, "brand_sales_mean", [0.25, 0.75])
    return t.select("*", *_tiers("brand_sales_mean", q25, q75,
                                 ["brand_performance_low", "brand_performance_medium", "brand_performance_high"]))


def store_brand_diversity(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """A3: per entity, product diversity and tiers."""
    s = stats if stats is not None else dims.entity_stats(df)
    t = s.select(*ENTITY, F.col("n_product").alias("product_diversity_count"),
                 F.col("q_sum").alias("sb_total_quantity"), F.col("a_sum").alias("sb_total_amount"))
    q33, q67 = quantiles(t, "product_diversity_count", [0.33, 0.67])
    return t.select("*", *_tiers("product_diversity_count", q33, q67,
                                 ["product_diversity_low", "product_diversity_medium", "product_diversity_high"]),
                    (F.col("sb_total_quantity") / F.col("product_diversity_count")).alias("avg_sales_per_product"))


def product_stats(df: DataFrame) -> DataFrame:
    """A4: per product (NULL product codes dropped).  One distinct count an aggregate, so that
    a fact that is dealt by product isn't shuffled."""
    known = df.where(F.col("product_code").isNotNull())
    platforms = known.groupBy("product_code").agg(F.count_distinct("primary_platform").alias("product_platform_count"))
    t = known.groupBy("product_code").agg(
        F.avg("sales_quantity").alias("product_sales_mean"),
        F.stddev_samp("sales_quantity").alias("product_sales_std"),
        F.sum("sales_quantity").alias("product_sales_total"),
        F.avg("unit_price").alias("product_price_mean"),
        F.count_distinct("store_name").alias("product_store_count")).join(platforms, "product_code")
    return t.select("*", flag(F.col("product_store_count") > 1).alias("product_multi_store"),
                    flag(F.col("product_platform_count") > 1).alias("product_multi_platform"))


def platform_share(df: DataFrame) -> DataFrame:
    """A5: platform share of total quantity (one row per platform)."""
    total = df.agg(F.sum("sales_quantity")).first()[0]
    p = df.groupBy("primary_platform").agg(F.sum("sales_quantity").alias("platform_total"))
    return p.select("primary_platform", "platform_total",
                    safe_div(F.col("platform_total"), F.lit(total)).alias("platform_market_share"))


def _share_in_platform(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Inner join of two aggregates (key totals and platform totals)."""
    plat = df.groupBy("primary_platform").agg(F.sum("sales_quantity").alias("platform_total"))
    t = df.groupBy("primary_platform", key).agg(F.sum("sales_quantity").alias(f"{prefix}_platform_total"))
    t = t.join(F.broadcast(plat), "primary_platform", "inner")
    share = safe_div(f"{prefix}_platform_total", "platform_total")
    return t.select("primary_platform", key, f"{prefix}_platform_total",
                    share.alias(f"{prefix}_platform_market_share"),
                    flag(share > 0.1).alias(f"dominant_{prefix}"),
                    flag(share > 0.3).alias(f"highly_concentrated_{prefix}"))


def store_share_in_platform(df: DataFrame) -> DataFrame:
    """A6 + A8 (store flags); J2 inner join of the two aggregates."""
    return _share_in_platform(df, "store_name", "store")


def brand_share_in_platform(df: DataFrame) -> DataFrame:
    """A7 + A8 (brand flags); also A36 (v1 brand share)."""
    return _share_in_platform(df, "brand_name", "brand")


def loyalty(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Relationship duration (round(days/30.44)) and consistency per entity."""
    s = stats if stats is not None else dims.entity_stats(df)
    dur = F.round(F.datediff("last_month", "first_month") / K.DAYS_PER_MONTH).cast("int")
    t = s.select(*ENTITY, F.col("n_rows").alias("relationship_months"), dur.alias("relationship_duration_months"))
    d = F.col("relationship_duration_months")
    cons = F.col("relationship_months") / (d + 1)
    return t.select(*ENTITY, "relationship_duration_months", cons.alias("relationship_consistency"),
                    flag(d >= 12).alias("long_term_relationship"),
                    flag((d >= 6) & (d < 12)).alias("medium_term_relationship"),
                    flag(d < 6).alias("short_term_relationship"),
                    flag(cons > 0.8).alias("high_consistency_relationship"))


def performance_categories(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """A10: high / steady / volatile / low performers per entity."""
    s = stats if stats is not None else dims.entity_stats(df)
    t = s.select(*ENTITY, F.col("q_mean").alias("entity_sales_mean"),
                 (F.col("q_std") / (F.col("q_mean") + 1)).alias("entity_sales_cv"))
    q33, q67 = quantiles(t, "entity_sales_mean", [0.33, 0.67])
    (med,) = quantiles(t, "entity_sales_cv", [0.5])
    m, cv = F.col("entity_sales_mean"), F.col("entity_sales_cv")
    lo, hi, c = F.lit(q33), F.lit(q67), F.lit(med)
    return t.select(*ENTITY, "entity_sales_cv",
                    flag((m > hi) & (cv < c)).alias("high_performer"),
                    flag((m > lo) & (m <= hi) & (cv < c)).alias("steady_performer"),
                    flag((m > hi) & (cv >= c)).alias("volatile_performer"),
                    flag(m <= lo).alias("low_performer"))

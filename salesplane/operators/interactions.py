"""Interaction features (I1-I4), top-k flags (K2, K3) and store-brand strength.

The data-dependent column lists (platforms, top brands, top platform-brand
pairs) come from small aggregates; only their names reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag, sanitize_name


def platforms_of(df: DataFrame) -> list:
    return sorted(r[0] for r in df.select("primary_platform").distinct().collect() if r[0] is not None)


def platform_interactions(df: DataFrame, platforms=None) -> DataFrame:
    """I1 month_<p>_interaction and I2 promo_<p>_interaction."""
    platforms = platforms or platforms_of(df)
    cols = []
    for p in platforms:
        on = (F.col("primary_platform") == p).cast("int")
        n = p.lower().replace(" ", "_")
        if "month" in df.columns:
            cols.append((F.col("month") * on).alias(f"month_{n}_interaction"))
        if "is_promotional_period" in df.columns:
            cols.append((F.col("is_promotional_period") * on).alias(f"promo_{n}_interaction"))
    return df.select("*", *cols)


def top_keys(df: DataFrame, keys, k: int) -> list:
    """K2/K3 helper: the k most frequent key tuples by row count (ties by key)."""
    rows = (df.groupBy(*keys).count().orderBy(F.desc("count"), *[F.asc(c) for c in keys])
            .limit(k).collect())
    return [tuple(r[c] for c in keys) for r in rows]


def seasonal_brand(df: DataFrame, k: int = 10, brands=None) -> DataFrame:
    """K2: seasonal_brand_<b> = month * [brand == b] for the top-k brands by row count."""
    brands = brands or [b for (b,) in top_keys(df, ["brand_name"], k)]
    m = F.col("month") if "month" in df.columns else F.month("sales_month")
    return df.select("*", *[(m * (F.col("brand_name") == b).cast("int")).alias(f"seasonal_brand_{sanitize_name(b)}")
                            for b in brands])


def platform_brand_flags(df: DataFrame, k: int = 15, pairs=None) -> DataFrame:
    """K3: platform_brand_<p>_<b> flags for the top-k (platform, brand) pairs by row count."""
    pairs = pairs or top_keys(df, ["primary_platform", "brand_name"], k)
    return df.select("*", *[flag((F.col("primary_platform") == p) & (F.col("brand_name") == b))
                            .alias(f"platform_brand_{p.lower().replace(' ', '_')}_{sanitize_name(b)}")
                            for p, b in pairs])


def store_brand_strength(df: DataFrame) -> DataFrame:
    """Per (store, brand): active months * mean quantity, / (max + 1e-6)."""
    t = df.groupBy("store_name", "brand_name").agg(
        (F.count_distinct("sales_month") * F.avg("sales_quantity")).alias("sb_relationship_strength")).persist()
    mx = t.agg(F.max("sb_relationship_strength")).first()[0]
    return t.select("store_name", "brand_name",
                    (F.col("sb_relationship_strength") / F.lit(mx + 1e-6)).alias("sb_relationship_score"))


def v1_products(df: DataFrame, target_year: int | None = None) -> DataFrame:
    """Brand x season x promo products (needs the v1 columns when present)."""
    cols = []
    have = set(df.columns)
    if {"brand_seasonal_index", "is_promo_month"} <= have:
        cols.append((F.col("brand_seasonal_index") * F.col("is_promo_month")).alias("brand_seasonal_promo"))
    if {"platform_seasonal_index", "brand_seasonal_index"} <= have:
        cols.append((F.col("platform_seasonal_index") * F.col("brand_seasonal_index")).alias("platform_brand_seasonal"))
    if {"sales_momentum_short", "brand_seasonal_index"} <= have:
        cols.append((F.col("sales_momentum_short") * F.col("brand_seasonal_index")).alias("trend_seasonal"))
    if {"is_top_brand", "is_promo_month"} <= have:
        cols.append((F.col("is_top_brand") * F.col("is_promo_month")).alias("top_brand_promo"))
    return df.select("*", *cols)

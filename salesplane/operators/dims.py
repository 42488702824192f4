"""Shared per-key aggregates: one ``groupBy`` per key family, persisted.

The store blocks (A1, A13, A15), the entity blocks (A3, A9, A10) and the
brand blocks (A2, A18) all need overlapping aggregates of the same key.  Each
family is aggregated once here (partial aggregation before the shuffle; the
distinct counts share one expand), persisted, and the blocks derive their
columns and thresholds from the small table.  Distinct products are counted
apart (``with_distinct``): a fact that is dealt by product isn't shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import cents_sum

ENTITY = ["primary_platform", "store_name", "brand_name"]
STORE = ["primary_platform", "store_name"]


def with_distinct(table: DataFrame, df: DataFrame, keys, column: str, name: str) -> DataFrame:
    """``table`` (one row for each ``keys`` of ``df``, null keys too) with the number of distinct
    values of ``column``.  Distinct rows come first, so that rows dealt by ``column`` stay
    where they are and only their counts are shuffled."""
    n = df.where(F.col(column).isNotNull()).select(*keys, column).distinct().groupBy(*keys).agg(F.count("*").alias("_n"))
    n = n.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return table.join(n, same, "left").select(*table.columns, F.coalesce("_n", F.lit(0).cast("long")).alias(name))


def store_stats(df: DataFrame) -> DataFrame:
    t = df.groupBy(*STORE).agg(
        F.avg("sales_quantity").alias("q_mean"), F.stddev_samp("sales_quantity").alias("q_std"),
        F.min("sales_quantity").alias("q_min"), F.max("sales_quantity").alias("q_max"),
        F.count("sales_quantity").alias("q_n"), F.sum("sales_quantity").alias("q_sum"),
        F.avg("sales_amount").alias("a_mean"), F.stddev_samp("sales_amount").alias("a_std"),
        F.avg("unit_price").alias("p_mean"), F.stddev_samp("unit_price").alias("p_std"),
        F.count_distinct("brand_name").alias("n_brand"), F.count_distinct("sales_month").alias("n_month"))
    return with_distinct(t, df, STORE, "product_code", "n_product").persist()


def entity_stats(df: DataFrame) -> DataFrame:
    t = df.groupBy(*ENTITY).agg(
        F.avg("sales_quantity").alias("q_mean"), F.stddev_samp("sales_quantity").alias("q_std"),
        F.sum("sales_quantity").alias("q_sum"), F.count("sales_month").alias("n_rows"),
        cents_sum("sales_amount").alias("a_sum"),
        F.min("sales_month").alias("first_month"), F.max("sales_month").alias("last_month"))
    return with_distinct(t, df, ENTITY, "product_code", "n_product").persist()


def brand_stats(df: DataFrame) -> DataFrame:
    t = df.groupBy("brand_name").agg(
        F.avg("sales_quantity").alias("q_mean"), F.stddev_samp("sales_quantity").alias("q_std"),
        F.sum("sales_quantity").alias("q_sum"), F.avg("sales_amount").alias("a_mean"),
        cents_sum("sales_amount").alias("a_sum"), F.avg("unit_price").alias("p_mean"),
        F.stddev_samp("unit_price").alias("p_std"), F.count_distinct("store_name").alias("n_store"),
        F.count_distinct("primary_platform").alias("n_platform"))
    return with_distinct(t, df, ["brand_name"], "product_code", "n_product").persist()

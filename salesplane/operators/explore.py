"""Exploratory result tables (X1-X18): aggregates that are reported, not joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import cents_sum
from ..functions.stats import group_quantiles


def platform_year_coverage(df: DataFrame) -> DataFrame:
    """X1."""
    return df.groupBy("primary_platform", F.year("sales_month").alias("year")).agg(
        F.min("sales_month").alias("first_month"), F.max("sales_month").alias("last_month"),
        F.count_distinct("sales_month").alias("months"), F.count("sales_quantity").alias("rows"),
        F.sum("sales_quantity").alias("quantity"), F.count_distinct("store_name").alias("stores"),
        F.count_distinct("brand_name").alias("brands"))


def missing_by_platform(df: DataFrame, cols=("store_name", "brand_name", "product_code")) -> DataFrame:
    """X2 / X3."""
    return df.groupBy("primary_platform").agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols])


def monthly_totals(df: DataFrame) -> DataFrame:
    """X4 / X7."""
    return df.groupBy(F.year("sales_month").alias("year"), F.month("sales_month").alias("month")).agg(
        F.sum("sales_quantity").alias("quantity"), cents_sum("sales_amount").alias("amount"),
        F.avg("sales_quantity").alias("mean_quantity"))


def platform_stats(df: DataFrame) -> DataFrame:
    """X5."""
    q = F.col("sales_quantity")
    return df.groupBy("primary_platform").agg(F.count(q).alias("count"), F.sum(q).alias("sum"), F.avg(q).alias("mean"),
                                              F.stddev_samp(q).alias("std"), F.min(q).alias("min"),
                                              F.max(q).alias("max"))


def month_platform_pivot(df: DataFrame, platforms) -> DataFrame:
    """Month x platform quantity, missing -> 0 (pivot values passed: no extra pass)."""
    return (df.groupBy("sales_month").pivot("primary_platform", list(platforms)).sum("sales_quantity").na.fill(0))


def quantity_percentiles(df: DataFrame) -> DataFrame:
    """X8."""
    q = F.col("q")
    return group_quantiles(df, [], ["sales_quantity"], [0.9, 0.95, 0.99, 1.0]).select(
        q[0].alias("p90"), q[1].alias("p95"), q[2].alias("p99"), q[3].alias("max"))


def top_rows(df: DataFrame, k: int = 5, col: str = "sales_quantity") -> DataFrame:
    """Top k rows by a column (a top-k report; ties by the row keys)."""
    return df.orderBy(F.desc(col), "sales_month", "primary_platform", "store_name", "brand_name",
                      "product_code").limit(k)


def sales_patterns(df: DataFrame, by) -> DataFrame:
    """Mean, median and count of quantity by any grouping
    (month, top-brand flag, store type, promo flags, season)."""
    rows = df.select(*by, "sales_quantity")
    keys = [c for c in rows.columns if c != "sales_quantity"]
    means = rows.groupBy(*keys).agg(F.avg("sales_quantity").alias("mean_quantity"), F.count("sales_quantity").alias("rows"))
    medians = group_quantiles(rows, keys, ["sales_quantity"], [0.5]).select(F.struct(*keys).alias("_g"), F.col("q")[0].alias("median_quantity"))
    return (means.withColumn("_g", F.struct(*keys)).join(medians, "_g", "left")
            .select(*keys, "mean_quantity", "median_quantity", "rows"))


def store_type_by_platform(df: DataFrame, type_col: str = "store_type") -> DataFrame:
    """Store type x platform rows, quantity and stores."""
    return df.groupBy(type_col, "primary_platform").agg(F.count("*").alias("rows"),
                                                         F.sum("sales_quantity").alias("quantity"),
                                                         F.count_distinct("store_name").alias("stores"))


def store_flag_totals(df: DataFrame, groups: dict[str, DataFrame], all_label: str = "all") -> DataFrame:
    """X11: (primary_platform, flag_group, flag, total): how many rows of ``df`` carry
    each 0/1 flag, by platform and over all platforms (``all_label``).

    ``groups`` names tables of flags, keyed by store_name or (primary_platform,
    store_name).  Rows are counted by store first, so only one row a store is
    joined; rows without a store, or without a row in a table, carry no flag.
    """
    keys = ["primary_platform", "store_name"]
    t, flags = df.groupBy(*keys).agg(F.count("*").alias("n_rows")), []
    for group, table in groups.items():
        on = [k for k in keys if k in table.columns]
        own = [c for c in table.columns if c not in keys]
        t = t.join(table.select(*on, *own), on, "left")
        flags += [(group, c) for c in own]
    totals = t.rollup("primary_platform").agg(
        F.grouping("primary_platform").alias("whole"),
        *[F.coalesce(F.sum(F.col("n_rows") * F.col(c)), F.lit(0)).cast("long").alias(c) for _, c in flags])
    rows = F.array(*[F.struct(F.lit(g).alias("flag_group"), F.lit(c).alias("flag"), F.col(c).alias("total")) for g, c in flags])
    return (totals.select(F.when(F.col("whole") == 1, F.lit(all_label)).otherwise(F.col("primary_platform")).alias("primary_platform"),
                          F.explode(rows).alias("r")).select("primary_platform", "r.*"))


def _brand_store_sums(df: DataFrame) -> DataFrame:
    return df.groupBy("primary_platform", "brand_name", "store_name").agg(F.sum("sales_quantity").alias("quantity"))


def platform_landscape(df: DataFrame) -> DataFrame:
    """Quantity, share of all quantity in per cent (two decimals), stores and
    brands of each platform; from one row for each (platform, brand, store)."""
    t = _brand_store_sums(df)
    per = t.groupBy("primary_platform").agg(F.sum("quantity").alias("quantity"), F.count_distinct("store_name").alias("stores"),
                                            F.count_distinct("brand_name").alias("brands"))
    total = per.agg(F.sum("quantity").alias("total_quantity"))  # one row
    share = F.floor(F.try_divide(F.col("quantity") * 100, F.col("total_quantity")) * 100 + 0.5) / 100
    return per.join(F.broadcast(total)).select("primary_platform", "quantity", share.alias("share_pct"), "stores", "brands")


def brand_reach(df: DataFrame) -> DataFrame:
    """Brands sold (quantity over 0) on one, two, and three or more platforms; rows without a brand don't count."""
    sold = (_brand_store_sums(df).where("brand_name is not null").groupBy("brand_name", "primary_platform")
            .agg(F.sum("quantity").alias("q")).groupBy("brand_name").agg(F.count_if(F.col("q") > 0).alias("np")))
    return sold.agg(F.count_if(F.col("np") == 1).alias("single_platform"), F.count_if(F.col("np") == 2).alias("dual_platform"),
                    F.count_if(F.col("np") >= 3).alias("multi_platform"))

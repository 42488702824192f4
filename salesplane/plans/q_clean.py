"""Registered queries: the cleaning chain that raw yearly files go through."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as cl
from .base import D, R, finalize, sales, sales_cte
from .catalog import register

PRODUCT = "CAST(product_code AS BIGINT)"
#: The sales view as a raw file would hold it: English headers, month as text in
#: two forms, platform aliases, missing stores and brands, zero quantities.
ALIASES = {"AUTOMOBILE": "jd", "BUILDING": "京东", "FURNITURE": "tmall", "HOUSEHOLD": "TikTok"}
MAPPED = {"AUTOMOBILE": "JD", "BUILDING": "JD", "FURNITURE": "Tmall", "HOUSEHOLD": "Douyin"}


def raw(spark, d):
    s = sales(spark, d)
    p = F.col("product_code").cast("long")
    alias = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    month = F.when(p % 2 == 0, F.date_format("sales_month", "yyyy-MM")).otherwise(F.date_format("sales_month", "yyyy-MM-dd"))
    return s.select(
        month.alias("Sales Month"), F.coalesce(alias[F.col("primary_platform")], "primary_platform").alias("Primary Platform (Original)"),
        F.when(p % 7 != 0, F.col("store_name")).alias("店铺名称"), F.when(p % 11 != 0, F.col("brand_name")).alias("Brand Name"),
        F.col("product_code").alias("商品编码"), F.col("sales_amount").alias("Sales Amount"),
        F.when(p % 13 == 0, F.lit(0.0)).otherwise(F.col("sales_quantity").cast("double")).alias("销售数量"))


def cleaned(spark, d, strict=False):
    return cl.parse_month(cl.map_platforms(cl.translate_columns(raw(spark, d)), strict=strict))


def _case(mapping, otherwise):
    return "CASE primary_platform " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {otherwise} END"


def _clean_sql(strict=False):
    return f"""WITH {sales_cte()},
c AS (SELECT sales_month, {_case(ALIASES, 'primary_platform')} AS primary_platform_original,
             CASE WHEN {PRODUCT} % 7 <> 0 THEN store_name END AS store_name, CASE WHEN {PRODUCT} % 11 <> 0 THEN brand_name END AS brand_name,
             product_code, sales_amount, CASE WHEN {PRODUCT} % 13 = 0 THEN 0.0 ELSE CAST(sales_quantity AS DOUBLE) END AS sales_quantity,
             {_case(MAPPED, 'NULL' if strict else 'primary_platform')} AS primary_platform FROM sales)"""


ALL = f"""{D('sales_month')} AS sales_month, primary_platform_original, primary_platform, store_name, brand_name, product_code,
{R('sales_amount')} AS sales_amount, {R('sales_quantity')} AS sales_quantity"""
COLS = ["sales_month", "primary_platform_original", "primary_platform", "store_name", "brand_name", "product_code",
        "sales_amount", "sales_quantity"]


@register("p1_p3_clean_input", f"{_clean_sql()} SELECT {ALL} FROM c")
def p1_clean_input(spark, d):
    """P1 headers, P2 platforms (unmapped kept), P3 months."""
    return finalize(cleaned(spark, d).select(*COLS))


@register("p2b_strict_platforms", f"""{_clean_sql(True)}
SELECT primary_platform_original, primary_platform, count(*) AS rows FROM c GROUP BY 1, 2""")
def p2b_strict(spark, d):
    return finalize(cleaned(spark, d, strict=True).groupBy("primary_platform_original", "primary_platform").agg(F.count("*").alias("rows")))


@register("p5_clean_infinite", f"""{_clean_sql()}
SELECT product_code, count(*) AS rows, {R('sum(CASE WHEN sales_quantity <> 0 THEN sales_amount / sales_quantity END)')} AS unit_price,
       CAST(count_if(sales_quantity = 0) AS BIGINT) AS removed FROM c GROUP BY product_code""")
def p5_infinite(spark, d):
    """P5 / P10: infinite unit prices become NULL."""
    x = cleaned(spark, d).withColumn("unit_price", F.when(F.col("sales_quantity") == 0, F.lit(float("inf")))
                                     .otherwise(F.col("sales_amount") / F.col("sales_quantity")))
    x = cl.clean_infinite_values(x)
    return finalize(x.groupBy("product_code").agg(F.count("*").alias("rows"), F.sum("unit_price").alias("unit_price"),
                                                  F.count_if(F.col("unit_price").isNull()).alias("removed")))


@register("p6_fill_unknown_dims", f"""{_clean_sql()}
SELECT coalesce(store_name, 'Unknown_Store') AS store_name, coalesce(brand_name, 'Unknown_Brand') AS brand_name, count(*) AS rows
FROM c GROUP BY 1, 2""")
def p6_fill(spark, d):
    return finalize(cl.fill_unknown_dims(cleaned(spark, d)).groupBy("store_name", "brand_name").agg(F.count("*").alias("rows")))


@register("p7_drop_missing_dims", f"""{_clean_sql(True)} SELECT {ALL} FROM c
WHERE primary_platform IS NOT NULL AND store_name IS NOT NULL AND brand_name IS NOT NULL""")
def p7_drop(spark, d):
    return finalize(cl.drop_missing_dims(cleaned(spark, d, strict=True)).select(*COLS))


@register("p20_positive_sales", f"{_clean_sql()} SELECT {ALL} FROM c WHERE sales_quantity > 0 AND sales_amount > 0")
def p20_positive(spark, d):
    return finalize(cl.filter_positive(cleaned(spark, d)).select(*COLS))


@register("p21_without_outliers", f"""{_clean_sql()} SELECT {ALL} FROM c
WHERE sales_quantity <= (SELECT quantile_cont(sales_quantity, 0.99) FROM c)""")
def p21_outliers(spark, d):
    return finalize(cl.filter_outliers(cleaned(spark, d)).select(*COLS))


@register("p22_period", f"""{_clean_sql()} SELECT {ALL} FROM c
WHERE sales_month >= DATE '1996-03-01' AND sales_month < DATE '1998-02-01' AND month(sales_month) IN (1, 6, 11)""")
def p22_period(spark, d):
    return finalize(cl.filter_period(cleaned(spark, d), start="1996-03-01", end="1998-02-01", months=[1, 6, 11]).select(*COLS))

"""Adapter from the star-schema test tables to the canonical sales fact.

sales_month = month of l_shipdate, primary_platform = c_mktsegment,
store_name = supplier nation name, brand_name = p_brand,
product_code = l_partkey; amounts are summed in exact cents.

Plan shape (what scales): orders take their customer's segment first, so that
lineitem is shuffled once on the order key for both; supplier keys with their
nation are broadcast when their counted rows are few, nation is a fixed 25-row
dimension.  The month-level aggregate runs *before* the part join (brand is a
function of the part key), so the part join sees the aggregated rows, not every
line item; it hashes each partition's parts and leaves those rows unsorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import cents

#: Store kinds in names of the sparse view: words that the store-type rules know.
STORE_KINDS = ("官方旗舰店", "旗舰店", "专卖店", "超市", "official", "经销商", "global", "corner")


#: Suppliers (two short columns) up to which they are broadcast.
BROADCAST_ROWS = 500_000
#: Rows of a join's smaller side for each shuffle partition up to which they are hashed,
#: so that the larger side isn't sorted.
HASH_ROWS = 1_000_000
#: Parts up to which the choice is Spark's, which broadcasts them if they are small enough.
PART_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hashed(spark: SparkSession, df: DataFrame, rows: int) -> DataFrame:
    """``df``, the smaller side of a shuffle join, marked for hashing if its partitions are small."""
    return df.hint("shuffle_hash") if rows <= HASH_ROWS * int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def _line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", cents("l_extendedprice").alias("_cents"), month.alias("sales_month"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    if (rows := cust.count()) > PART_ROWS:
        cust = _hashed(spark, cust, rows)
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if supp.count() <= BROADCAST_ROWS:
        supp = F.broadcast(supp)
    placed = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_mktsegment")
    placed = _hashed(spark, placed, orders.count())
    return (li.join(supp, li.l_suppkey == supp.s_suppkey)
              .select("l_orderkey", "l_partkey", "l_quantity", "_cents", "sales_month", "s_nationkey")
              .join(placed, F.col("l_orderkey") == F.col("o_orderkey")))


def sales_from_tpch(spark: SparkSession, sf_dir: str, sparse: bool = False, by_product: bool = False) -> DataFrame:
    """Canonical sales fact (FIXTURES F3).

    ``sparse=True`` names stores and brands from more columns, every row kept:
    stores of two nations in three sell on one platform only (nation and
    platform) and carry a kind, and brands are a store's own label but for every
    first to fourth number, so single-platform stores, all levels of competition
    and several store types occur.

    ``by_product``: the same rows, dealt by product_code (for a caller that repartitions
    by it): one shuffle serves the aggregate, the part join and the caller.
    """
    lines = _line_facts(spark, sf_dir)
    if by_product:  # the key under the name and type that the caller knows
        lines = lines.withColumn("l_partkey", F.col("l_partkey").cast("string")).repartition("l_partkey")
    agg = (lines.groupBy("sales_month", F.col("c_mktsegment").alias("primary_platform"), "s_nationkey", "l_partkey")
           .agg(F.sum("_cents").alias("_cents"), F.sum("l_quantity").alias("_quantity")))
    # A nation that comes several times under one name counts its lines as often.
    nation = (table(spark, sf_dir, "nation").groupBy(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("store_name"))
              .agg(F.count("*").alias("_times")))
    number = F.regexp_extract("p_brand", r"(\d+)$", 1)  # once a part, not once a row
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", *([number.alias("_number")] if sparse else []))
    if by_product:
        part = part.withColumn("p_partkey", F.col("p_partkey").cast("string"))
    if (rows := part.count()) > PART_ROWS or by_product:
        part = _hashed(spark, part, rows)
    out = agg.join(part, agg.l_partkey == part.p_partkey).join(F.broadcast(nation), agg.s_nationkey == F.col("_nk"))
    store, brand = F.col("store_name"), F.col("p_brand")
    if sparse:
        nk, bn = F.col("_nk"), F.col("_number").cast("int")
        brand = F.when(bn % (1 + nk % 4) == 0, brand).otherwise(F.concat_ws(" ", brand, store))
        kind = F.array(*[F.lit(k) for k in STORE_KINDS])[F.pmod(nk, F.lit(len(STORE_KINDS))).cast("int")]
        store = F.when(nk % 3 == 0, F.concat_ws(" ", store, kind)).otherwise(F.concat_ws(" ", store, "primary_platform", kind))
    return out.select(
        "sales_month", "primary_platform",
        F.lit(None).cast("string").alias("secondary_platform"),
        store.alias("store_name"), brand.alias("brand_name"),
        F.col("l_partkey").cast("string").alias("product_code"),
        ((F.col("_cents") * F.col("_times")).cast("double") / 100).alias("sales_amount"),
        (F.col("_quantity") * F.col("_times")).alias("sales_quantity"))


def daily_calendar(spark: SparkSession, sf_dir: str, leap_year: int = 2000) -> DataFrame:
    """FIXTURES F5: distinct order dates plus every day of one leap year."""
    od = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    leap = spark.range(1).select(F.explode(F.sequence(
        F.make_date(F.lit(leap_year), F.lit(1), F.lit(1)),
        F.make_date(F.lit(leap_year), F.lit(12), F.lit(31)))).alias("d"))
    return od.union(leap).distinct()

"""Shared inputs of the registered queries: the sales fact and its setup.

Both sides of the oracle check start from the same definition: the Spark
builders below and the DuckDB CTEs in ``SALES_CTE`` / ``BASE_CTE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import r6
from ..operators.clean import base_setup
from ..sources.tpch import STORE_KINDS, sales_from_tpch


def sales(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    return sales_from_tpch(spark, sf_dir, sparse=sparse)


_BASE: dict = {}


def base(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """Sales fact after step 1 (unit price, log target, quality flags).

    Persisted (memory and disk) once per session and input: every block and
    every global threshold reads it, so the six-table join runs once.  A lost
    executor only costs a recompute of its partitions from lineage.
    """
    key = (sf_dir.rstrip("/"), sparse)
    hit = _BASE.get(key)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    df = base_setup(sales(spark, sf_dir, sparse).persist())
    _BASE[key] = (spark, df)
    return df


def forget(spark: SparkSession) -> None:
    """Drop every persisted table, so that the next query starts cold."""
    _BASE.clear()
    spark.catalog.clearCache()


def finalize(df: DataFrame) -> DataFrame:
    """Output normal form for the oracle: doubles rounded by ``r6``, dates as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(r6(c.cast("double")).alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


# ----------------------------------------------------------------- DuckDB ----

def R(expr: str) -> str:
    """Oracle twin of ``r6``."""
    return f"(floor(({expr}) * 1e6 + 0.5) / 1e6 + 0.0)"


def D(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


_SALES_SELECT = """
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS sales_month,
         c_mktsegment AS primary_platform,
         CAST(NULL AS VARCHAR) AS secondary_platform,
         {names},
         CAST(l_partkey AS VARCHAR) AS product_code,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS sales_amount,
         SUM(l_quantity) AS sales_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey
  GROUP BY ALL"""

_NAMES = "n_name AS store_name, p_brand AS brand_name"
_KIND = f"[{', '.join(repr(k) for k in STORE_KINDS)}][n_nationkey % {len(STORE_KINDS)} + 1]"
_SPARSE_NAMES = f"""n_name || CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE ' ' || c_mktsegment END || ' ' || {_KIND} AS store_name,
         CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % (1 + n_nationkey % 4) = 0 THEN p_brand
              ELSE p_brand || ' ' || n_name END AS brand_name"""


def sales_cte(sparse: bool = False, name: str = "sales") -> str:
    return f"{name} AS ({_SALES_SELECT.format(names=_SPARSE_NAMES if sparse else _NAMES)})"


def base_cte(sparse: bool = False) -> str:
    """sales + unit price (NULL -> median), log target, quality flags."""
    return (sales_cte(sparse) + """,
  priced AS (SELECT *, CASE WHEN sales_quantity <> 0 THEN sales_amount / sales_quantity END AS up FROM sales),
  pstat AS (SELECT quantile_cont(up, 0.5) AS med FROM priced),
  priced2 AS (SELECT priced.* EXCLUDE (up), coalesce(up, med) AS unit_price FROM priced, pstat),
  pq AS (SELECT quantile_cont(unit_price, 0.95) AS q95 FROM priced2),
  base AS (SELECT priced2.*, ln(1 + sales_quantity) AS sales_quantity_log,
                  CAST(unit_price IS NULL AS INTEGER) AS has_missing_price,
                  CAST(sales_quantity = 0 AS INTEGER) AS has_zero_sales,
                  CAST(coalesce(unit_price > q95, false) AS INTEGER) AS has_high_price
           FROM priced2, pq)""")


def with_base(body: str, sparse: bool = False) -> str:
    return f"WITH {base_cte(sparse)}\n{body}"


def with_base_ctes(ctes: str, body: str, sparse: bool = False) -> str:
    return f"WITH {base_cte(sparse)},\n{ctes}\n{body}"

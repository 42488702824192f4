"""Cleaning, projections and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.exprs import finite, flag, safe_div
from ..functions.stats import quantile, quantiles

ENTITY = ["primary_platform", "store_name", "brand_name"]
NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType,
                 T.ByteType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def translate_columns(df: DataFrame, mapping: dict = K.HEADER_MAP) -> DataFrame:
    """Rename raw (Chinese or English) headers to canonical names."""
    present = {k: v for k, v in mapping.items() if k in df.columns and v not in df.columns}
    return df.withColumnsRenamed(present) if present else df


def map_platforms(df: DataFrame, aliases: dict = K.PLATFORM_ALIASES, strict: bool = False) -> DataFrame:
    """P2 (unmapped kept) / P2b (``strict``: unmapped -> NULL).

    When ``primary_platform`` is absent it is derived from ``primary_platform_original``.
    """
    if "primary_platform" not in df.columns and "primary_platform_original" in df.columns:
        df = df.withColumn("primary_platform", F.col("primary_platform_original"))
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    looked = m[F.col("primary_platform")]
    return df.withColumn("primary_platform", looked if strict else F.coalesce(looked, F.col("primary_platform")))


def parse_month(df: DataFrame, column: str = "sales_month") -> DataFrame:
    """Text 'YYYY-MM[-DD]' or timestamp -> month-start date."""
    c = F.col(column)
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        d = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "yyyy-MM"))
    else:
        d = c.cast("date")
    return df.withColumn(column, F.trunc(d, "MM"))


def clean_infinite_values(df: DataFrame, columns=None) -> DataFrame:
    """P5 / P10: +-inf (and NaN) -> NULL on numeric columns, one select."""
    cols = set(columns or [c for c in numeric_columns(df)
                           if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))])
    return df.select(*[F.when(finite(c), F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def fill_unknown_dims(df: DataFrame) -> DataFrame:
    """P6."""
    return df.fillna({"store_name": "Unknown_Store", "brand_name": "Unknown_Brand"})


def drop_missing_dims(df: DataFrame, subset=("primary_platform", "store_name", "brand_name")) -> DataFrame:
    """P7."""
    return df.dropna(subset=list(subset))


def add_unit_price(df: DataFrame, median: float | None = None) -> DataFrame:
    """a/q, +-inf and 0/0 -> NULL, NULL -> global median of the finite prices."""
    df = df.withColumn("unit_price", safe_div("sales_amount", "sales_quantity"))
    if median is None:
        median = quantile(df, "unit_price", 0.5, fact=True)
    return df.withColumn("unit_price", F.coalesce(F.col("unit_price"), F.lit(median).cast("double")))


def base_setup(df: DataFrame, high_price_q: float = 0.95) -> DataFrame:
    """Step 1: P4 unit price, P8 log target, P9 quality flags.

    The input is persisted first: the median and the q95 are global scalars
    (actions), and without it each would re-run the upstream joins.
    """
    df = df.persist()
    if "unit_price" not in df.columns:
        df = df.withColumn("unit_price", safe_div("sales_amount", "sales_quantity"))
        n_missing = df.where(F.col("unit_price").isNull()).count()
        med, q95 = quantiles(df, "unit_price", [0.5, high_price_q], fact=True)
        df = df.withColumn("unit_price", F.coalesce(F.col("unit_price"), F.lit(med).cast("double")))
        if n_missing:  # the fill changes the distribution the q95 is taken over
            q95 = quantile(df, "unit_price", high_price_q, fact=True)
    else:
        q95 = quantile(df, "unit_price", high_price_q, fact=True)
    return df.select(
        "*",
        F.log1p("sales_quantity").alias("sales_quantity_log"),
        flag(F.col("unit_price").isNull()).alias("has_missing_price"),
        flag(F.col("sales_quantity") == 0).alias("has_zero_sales"),
        flag(F.col("unit_price") > F.lit(q95)).alias("has_high_price"))


def inverse_target(c="sales_quantity_log"):
    """P8 inverse."""
    return F.expm1(F.col(c) if isinstance(c, str) else c)


def column_stats(df: DataFrame, weight: str | None = None) -> dict:
    """Integer-column maxima in chunked aggregate passes, the exact median of each
    _score/_index column.  ``weight``: column with the number of rows that a row stands for."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    nums = numeric_columns(df)
    is_ratio = lambda c: any(s in c for s in ("_ratio", "_share", "_cv", "_pct"))
    is_score = lambda c: any(s in c for s in ("_score", "_index"))
    aggs = [F.max(c).alias(f"max__{c}") for c in ints if c != weight]
    scores = [c for c in nums if is_score(c) and not is_ratio(c)]
    return {**_chunked_agg(df, aggs), **{f"med__{c}": quantile(df, c, 0.5, weight=weight) for c in scores}}


def fill_missing_values(df: DataFrame, stats: dict | None = None) -> DataFrame:
    """Name-pattern fill, rules applied in order.

    1. integer columns whose max <= 1 -> 0;  2. _ratio/_share/_cv/_pct -> 0;
    3. _score/_index -> column median;      4. other numeric -> 0.
    Column maxima and medians come from one aggregate pass.
    """
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    nums = numeric_columns(df)
    is_ratio = lambda c: any(s in c for s in ("_ratio", "_share", "_cv", "_pct"))
    is_score = lambda c: any(s in c for s in ("_score", "_index"))
    stats = column_stats(df) if stats is None else stats
    out = []
    for c in df.columns:
        if c not in nums:
            out.append(F.col(c))
            continue
        binary = c in ints and (stats.get(f"max__{c}") is None or stats[f"max__{c}"] <= 1)
        if binary or is_ratio(c) or not is_score(c):
            fill = 0
        else:
            fill = stats.get(f"med__{c}")
            fill = 0 if fill is None else fill
        out.append(F.coalesce(F.col(c), F.lit(fill).cast(df.schema[c].dataType)).alias(c))
    return df.select(*out)


def _chunked_agg(df: DataFrame, aggs, chunk: int = 80) -> dict:
    """Global aggregates in chunks, keeping each generated method under the JVM size limit."""
    out = {}
    for i in range(0, len(aggs), chunk):
        out.update(df.agg(*aggs[i:i + chunk]).first().asDict())
    return out


def drop_temp_columns(df: DataFrame) -> DataFrame:
    """P13."""
    return df.drop(*[c for c in df.columns if "_temp_" in c or "_intermediate_" in c])


def ensure_dtypes(df: DataFrame, stats: dict | None = None) -> DataFrame:
    """Binary ints/bools and _count/_nunique/_rank -> int, double -> float.

    ``stats`` (from ``column_stats`` before the fill) saves a pass: filling
    NULLs with 0 cannot lift a column's maximum above 1.
    """
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.IntegerType, T.LongType, T.BooleanType))]
    if stats is not None and all(f"max__{c}" in stats for c in ints
                                 if not isinstance(df.schema[c].dataType, T.BooleanType)):
        mx = {c: (stats.get(f"max__{c}") if f"max__{c}" in stats else 1) for c in ints}
        mx = {c: (0 if v is None else v) for c, v in mx.items()}
    else:
        mx = _chunked_agg(df, [F.max(F.col(c).cast("long")).alias(c) for c in ints])
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        counted = any(s in f.name for s in ("_count", "_nunique", "_rank"))
        if f.name in mx and (mx[f.name] is None or mx[f.name] <= 1):
            out.append(c.cast("int").alias(f.name))
        elif counted and isinstance(f.dataType, (T.LongType, T.DoubleType)):
            out.append(c.cast("int").alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            out.append(c.cast("float").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# --- FIXED VALUES: name substrings that exclude a column from modelling -----
MODEL_EXCLUDE_SUBSTRINGS = ["sales_month", "store_name", "brand_name", "product_code",
                            "primary_platform_original", "secondary_platform",
                            "sales_amount", "sales_quantity",
                            "_temp_", "_intermediate_", "entity_key", "store_platform_key"]

# --- FIXED VALUES: feature taxonomy, first matching rule wins ---------------
FEATURE_TAXONOMY = [
    ("temporal_basic", ["month", "quarter", "year", "day_of_year"]),
    ("temporal_cyclical", ["_sin", "_cos"]),
    ("promotional", ["promotional", "promo", "holiday"]),
    ("lag_features", ["_lag_"]),
    ("rolling_features", ["rolling_"]),
    ("momentum_features", ["momentum", "trend_", "acceleration", "volatility"]),
    ("customer_behavior", ["store_", "brand_", "market_share", "diversity"]),
    ("store_categorization", ["store_type_", "quality_", "business_model", "competitive_"]),
    ("platform_dynamics", ["platform_", "cross_platform"]),
    ("interactions", ["interaction"]),
    ("spike_detection", ["spike_", "z_score", "deviation"]),
]


def modeling_features(df: DataFrame, exclude_substrings=MODEL_EXCLUDE_SUBSTRINGS,
                      exclude_exact=None) -> list:
    """P15 (substring rule) / P16 (``exclude_exact`` names)."""
    out = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, NUMERIC_TYPES + (T.BooleanType,)):
            continue
        if exclude_exact is not None:
            if f.name in exclude_exact:
                continue
        elif any(s in f.name for s in exclude_substrings):
            continue
        out.append(f.name)
    return out


def categorize_features(features, rules=FEATURE_TAXONOMY, target="sales_quantity_log") -> dict:
    """Ordered first-match taxonomy over column names (schema only)."""
    cats = {name: [] for name, _ in rules}
    cats["target"] = []
    for f in features:
        for name, subs in rules:
            if any(s in f for s in subs):
                cats[name].append(f)
                break
        else:
            if f == target:
                cats["target"].append(f)
    return cats


def filter_positive(df: DataFrame, cols=("sales_quantity", "sales_amount")) -> DataFrame:
    """P20: keep rows with positive sales."""
    cond = None
    for c in cols:
        cond = (F.col(c) > 0) if cond is None else cond & (F.col(c) > 0)
    return df.where(cond)


def filter_outliers(df: DataFrame, column="sales_quantity", q=0.99) -> DataFrame:
    """Drop rows above the global q-quantile."""
    thr = quantile(df, column, q)
    return df.where(F.col(column) <= F.lit(thr))


def filter_period(df: DataFrame, start=None, end=None, years=None, months=None,
                  column="sales_month") -> DataFrame:
    """Half-open [start, end) range, year list, month list (push down to Parquet)."""
    c = F.col(column)
    if start is not None:
        df = df.where(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(c < F.lit(end).cast("date"))
    if years is not None:
        df = df.where(F.year(c).isin(list(years)))
    if months is not None:
        df = df.where(F.month(c).isin(list(months)))
    return df


def global_thresholds(df: DataFrame, column: str, probs) -> list:
    return quantiles(df, column, probs)


def one_hot(df: DataFrame, column: str, levels=None, prefix: str | None = None) -> DataFrame:
    """0/1 column per level (levels from a distinct aggregate when not given)."""
    if levels is None:
        levels = sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)
    p = prefix if prefix is not None else column
    return df.select("*", *[flag(F.col(column) == lv).alias(f"{p}_{lv}") for lv in levels])


def one_hot_to_label(df: DataFrame, columns, out: str, prefix: str = "") -> DataFrame:
    """Label of the first column holding the row maximum (idxmax), prefix stripped."""
    arr = F.array(*[F.col(c).cast("double") for c in columns])
    names = F.array(*[F.lit(c[len(prefix):] if prefix and c.startswith(prefix) else c) for c in columns])
    return df.withColumn(out, F.element_at(names, F.array_position(arr, F.array_max(arr)).cast("int")))

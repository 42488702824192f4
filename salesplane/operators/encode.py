"""Fitted encoders and scalers (M1-M9), fitted on training rows only, per split.

Fitted state is a small table keyed by ``split_id`` (edges, medians, IQRs);
applying it is a broadcast join on ``split_id`` plus built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import group_quantiles


def fit_quantile_edges(train: DataFrame, col: str, bins: int = 50, by=("split_id",)) -> DataFrame:
    """M1 fit: unique quantile edges (0..1 in ``bins`` steps) of the non-zero training values."""
    probs = [i / bins for i in range(bins + 1)]
    return group_quantiles(train.where(F.col(col) != 0), list(by), [col], probs).select(*by, F.array_distinct("q").alias("edges"))


def apply_buckets(df: DataFrame, edges: DataFrame, col: str, out: str, clip_max: int = 51, by=("split_id",)) -> DataFrame:
    """M1 apply: index = number of edges <= x, clipped to ``clip_max``; 0 without edges."""
    j = df.join(F.broadcast(edges), list(by), "left")
    idx = F.size(F.filter(F.coalesce(F.col("edges"), F.array().cast("array<double>")), lambda e: e <= F.col(col)))
    return j.withColumn(out, F.least(idx, F.lit(clip_max))).drop("edges")


def fit_robust(train: DataFrame, cols, by=("split_id",)) -> DataFrame:
    """M4 fit: median and IQR (exact, linear) per column; IQR 0 -> 1."""
    q = group_quantiles(train, list(by), list(cols), [0.25, 0.5, 0.75])
    t = q.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"_q_{c}") for c in cols])
    out = [*by]
    for c in cols:
        iqr = F.col(f"_q_{c}")[2] - F.col(f"_q_{c}")[0]
        out += [F.col(f"_q_{c}")[1].alias(f"{c}__median"), F.when(iqr == 0, 1.0).otherwise(iqr).alias(f"{c}__iqr")]
    return t.select(*out)


def apply_robust(df: DataFrame, fitted: DataFrame, cols, by=("split_id",)) -> DataFrame:
    j = df.join(F.broadcast(fitted), list(by), "left")
    return j.select(*[c for c in df.columns if c not in cols],
                    *[((F.col(c) - F.col(f"{c}__median")) / F.col(f"{c}__iqr")).alias(c) for c in cols])


def fit_standard(train: DataFrame, cols, by=("split_id",)) -> DataFrame:
    """M5 fit: mean and population std (ddof 0), std 0 -> 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"_s_{c}")]
    t = train.groupBy(*by).agg(*aggs)
    return t.select(*by, *[F.col(f"{c}__mean") for c in cols],
                    *[F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}")).alias(f"{c}__std") for c in cols])


def standard_of(moments: DataFrame, cols, by=("split_id",)) -> DataFrame:
    """M5 fit from ``splits.train_moments``: as fit_standard."""
    return moments.select(*by, *[F.col(f"{c}__mean") for c in cols],
                          *[F.when(F.col(f"{c}__std") == 0, 1.0).otherwise(F.col(f"{c}__std")).alias(f"{c}__std") for c in cols])


def minmax_of(moments: DataFrame, cols, by=("split_id",)) -> DataFrame:
    """M6 fit from ``splits.train_moments``: as fit_minmax."""
    return moments.select(*by, *[F.col(f"{c}__min") for c in cols], *[F.col(f"{c}__max") for c in cols])


def apply_minmax(df: DataFrame, fitted: DataFrame, cols, by=("split_id",)) -> DataFrame:
    """M6 apply: (x - min) / (max - min), a range of 0 counts as 1."""
    j = df.join(F.broadcast(fitted), list(by), "left")
    span = {c: F.col(f"{c}__max") - F.col(f"{c}__min") for c in cols}
    return j.select(*[c for c in df.columns if c not in cols],
                    *[((F.col(c) - F.col(f"{c}__min")) / F.when(span[c] == 0, 1.0).otherwise(span[c])).alias(c) for c in cols])


def target_encode_of(by_key: DataFrame, overall: DataFrame, key: str, y: str, k: float = 1.0, s: float = 1.0) -> DataFrame:
    """M9 from ``splits.train_moments`` by ``key`` and over all: as target_encode."""
    prior = overall.select("split_id", F.col(f"{y}__mean").alias("_prior"))
    w = 1 / (1 + F.exp(-(F.col(f"{y}__n") - k) / s))
    return (by_key.join(F.broadcast(prior), "split_id")
            .select("split_id", key, (w * F.col(f"{y}__mean") + (1 - w) * F.col("_prior")).alias(f"{key}_te")))


def apply_standard(df: DataFrame, fitted: DataFrame, cols, by=("split_id",)) -> DataFrame:
    j = df.join(F.broadcast(fitted), list(by), "left")
    return j.select(*[c for c in df.columns if c not in cols],
                    *[((F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std")).alias(c) for c in cols])


def fit_minmax(train: DataFrame, cols, by=("split_id",)) -> DataFrame:
    """M6 fit."""
    return train.groupBy(*by).agg(*[F.min(c).alias(f"{c}__min") for c in cols],
                                  *[F.max(c).alias(f"{c}__max") for c in cols])


def nan_to_num(c, nan=0.0, posinf=1e6, neginf=-1e6):
    """M7."""
    x = F.col(c) if isinstance(c, str) else c
    return (F.when(x.isNull() | F.isnan(x), F.lit(nan)).when(x == float("inf"), F.lit(posinf))
            .when(x == float("-inf"), F.lit(neginf)).otherwise(x))


def index_clip(c, lo=0, hi=100, shift=0):
    """M2: calendar part -> index (e.g. month-1), clipped."""
    x = F.col(c) if isinstance(c, str) else c
    return F.least(F.greatest(x - shift, F.lit(lo)), F.lit(hi))


def fit_year_map(train: DataFrame, by=("split_id",), col="year") -> DataFrame:
    """M3 fit: training years -> 0-based dense index."""
    from pyspark.sql import Window
    ys = train.select(*by, F.col(col)).where(F.col(col).isNotNull()).distinct()
    return ys.withColumn("year_index", F.dense_rank().over(Window.partitionBy(*by).orderBy(col)) - 1)


def apply_year_map(df: DataFrame, year_map: DataFrame, by=("split_id",), col="year") -> DataFrame:
    """M3 apply: the fitted index; unseen or null years get 0.  The map has one row
    per split and training year."""
    return (df.join(F.broadcast(year_map), [*by, col], "left")
            .withColumn("year_index", F.coalesce("year_index", F.lit(0))))


def target_encode(train: DataFrame, key: str, y: str, k: float = 1.0, s: float = 1.0, by=("split_id",)) -> DataFrame:
    """M9: smoothed mean encoding w*mean + (1-w)*prior, w = 1/(1+exp(-(n-k)/s))."""
    prior = train.groupBy(*by).agg(F.avg(y).alias("_prior"))
    t = train.groupBy(*by, key).agg(F.avg(y).alias("_m"), F.count(y).alias("_n")).join(F.broadcast(prior), list(by))
    w = 1 / (1 + F.exp(-(F.col("_n") - k) / s))
    return t.select(*by, key, (w * F.col("_m") + (1 - w) * F.col("_prior")).alias(f"{key}_te"))

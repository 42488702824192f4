"""Calendar parts (T1-T13) and per-entity window features.

Every ordered feature uses one window specification, ``entity_window()``:
partition by entity (platform, store, brand), order by (sales_month,
product_code).  Catalyst then plans a single exchange + sort for all of them
(the windows share partitioning and ordering), instead of one shuffle per
feature family.  Frames are ROWS frames: lags count rows, not months.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import finite, flag, pct_change
from ..functions.stats import sorted_quantile

ENTITY = ["primary_platform", "store_name", "brand_name"]
ORDER = ["sales_month", "product_code"]
LAGS = [1, 2, 3, 6, 12]
ROLL = [3, 6, 12]


def entity_window(entity=ENTITY, order=ORDER):
    """The sort before time-series work is a window ordering, never a
    materialised sort; entities are grouped by their columns, not a concatenated key."""
    return Window.partitionBy(*entity).orderBy(*order)


def frame(k: int, entity=ENTITY, order=ORDER):
    """Trailing ROWS frame of k rows ending at the current row."""
    return entity_window(entity, order).rowsBetween(-(k - 1), 0)


def whole(entity=ENTITY):
    return Window.partitionBy(*entity)


def with_group_stats(df: DataFrame, keys, aggs, source: DataFrame | None = None) -> DataFrame:
    """Whole-group statistics as a grouped aggregate joined back (not an unordered
    window): partial aggregation splits a hot group over many tasks, and the small
    result is attached with a size-checked join.  ``source`` (default ``df``) is the
    table aggregated: pass the persisted base so a wide derived frame is not recomputed."""
    from .behaviour import attach
    src = df if source is None else source
    return attach(df, [src.groupBy(*keys).agg(*aggs)], keys)


# ---------------------------------------------------------------- T blocks --

def calendar_parts(df: DataFrame, date_col="sales_month", epoch=K.EPOCH_DATE) -> DataFrame:
    """Calendar parts, progress, cyclical encodings, season flags."""
    d = F.col(date_col)
    m, q = F.month(d), F.quarter(d)
    doy, wk = F.dayofyear(d), F.weekofyear(d)
    two_pi = 2 * math.pi
    return df.select(
        "*",
        m.alias("month"), q.alias("quarter"), F.year(d).alias("year"),
        doy.alias("day_of_year"), wk.alias("week_of_year"),
        F.datediff(d, F.lit(epoch).cast("date")).alias("days_since_epoch"),
        ((m - 1) / 11).alias("month_progress"),
        ((q - 1) / 3).alias("quarter_progress"),
        F.sin(two_pi * (m - 1) / 12).alias("month_sin"),
        F.cos(two_pi * (m - 1) / 12).alias("month_cos"),
        F.sin(two_pi * (q - 1) / 4).alias("quarter_sin"),
        F.cos(two_pi * (q - 1) / 4).alias("quarter_cos"),
        F.sin(two_pi * doy / 365.25).alias("day_of_year_sin"),
        F.cos(two_pi * doy / 365.25).alias("day_of_year_cos"),
        F.sin(two_pi * wk / 52).alias("week_sin"),
        F.cos(two_pi * wk / 52).alias("week_cos"),
        flag(m.isin(K.HOLIDAY_SEASON_MONTHS)).alias("is_holiday_season"),
        flag(m.isin(K.MID_YEAR_MONTHS)).alias("is_mid_year_shopping"),
        flag(m.isin(K.BACK_TO_SCHOOL_MONTHS)).alias("is_back_to_school"))


def days_since_start(df: DataFrame, date_col="sales_month") -> DataFrame:
    """T2 v1: days since the table's first date (a 1-row broadcast scalar)."""
    first = df.agg(F.min(date_col).alias("_d0"))
    return df.crossJoin(F.broadcast(first)).withColumn(
        "days_since_start", F.datediff(F.col(date_col), F.col("_d0"))).drop("_d0")


def cyclical_v1(df: DataFrame, date_col="sales_month") -> DataFrame:
    """T5: sin/cos of 2pi*m/12 and 2pi*q/4."""
    m, q = F.month(date_col), F.quarter(date_col)
    return df.select("*", F.sin(2 * math.pi * m / 12).alias("month_sin_v1"),
                     F.cos(2 * math.pi * m / 12).alias("month_cos_v1"),
                     F.sin(2 * math.pi * q / 4).alias("quarter_sin_v1"),
                     F.cos(2 * math.pi * q / 4).alias("quarter_cos_v1"))


def promo_month_features(df: DataFrame, month_col="month", promo_months=K.PROMO_MONTHS_V1) -> DataFrame:
    """v1 promo-month flag, distances, pre-promo flag, season group + one-hot."""
    m = F.col(month_col)
    pm = F.array(*[F.lit(p) for p in promo_months])
    circ = F.array_min(F.transform(pm, lambda p: F.least(F.abs(m - p), 12 - F.abs(m - p))))
    nearest = F.array_min(F.transform(pm, lambda p: F.abs(m - p)))
    later = F.array_min(F.filter(pm, lambda p: p > m))
    nxt = F.coalesce(later - m, (12 - m) + F.lit(min(promo_months)))
    pre = [(p - 1) if p > 1 else 12 for p in promo_months]
    group = F.lit(K.SEASON_GROUP_V1_OTHER)
    for name, months in reversed(K.SEASON_GROUPS_V1):
        group = F.when(m.isin(months), F.lit(name)).otherwise(group)
    names = [g for g, _ in K.SEASON_GROUPS_V1] + [K.SEASON_GROUP_V1_OTHER]
    out = df.select("*", flag(m.isin(promo_months)).alias("is_promo_month_v1"),
                    circ.alias("months_to_promo"),
                    nearest.alias("distance_to_nearest_promo"),
                    nxt.alias("distance_to_next_promo"),
                    flag(m.isin(promo_months)).alias("is_promo_month"),
                    flag(m.isin(pre)).alias("is_pre_promo_month"),
                    group.alias("season_group"))
    return out.select("*", *[flag(F.col("season_group") == g).alias(f"season_{g}") for g in names])


def month_from_text(c, defect: bool = False):
    """Month number from 'YYYY-MM'; ``defect`` reproduces the year-capturing regex."""
    return F.regexp_extract(F.col(c) if isinstance(c, str) else c,
                            r"(\d+)" if defect else r"-(\d+)", 1).cast("int")


def year_flag(df: DataFrame, year: int, date_col="sales_month") -> DataFrame:
    """is_<year> flag (the year is a parameter)."""
    return df.withColumn(f"is_{year}", flag(F.year(date_col) == year))


# ---------------------------------------------------------------- W blocks --

def lag_features(df: DataFrame, lags=LAGS, entity=ENTITY) -> DataFrame:
    """{sales, amount, price}_lag_k, NULL -> 0."""
    w = entity_window(entity)
    cols = []
    for k in lags:
        cols.append(F.coalesce(F.lag("sales_quantity", k).over(w), F.lit(0.0)).alias(f"sales_lag_{k}"))
        cols.append(F.coalesce(F.lag("sales_amount", k).over(w), F.lit(0.0)).alias(f"amount_lag_{k}"))
        if "unit_price" in df.columns:
            cols.append(F.coalesce(F.lag("unit_price", k).over(w), F.lit(0.0)).alias(f"price_lag_{k}"))
    return df.select("*", *cols)


def rolling_features(df: DataFrame, windows=ROLL, entity=ENTITY) -> DataFrame:
    """Rolling mean/std/min/max/cv/median/q25/q75 (min_periods=1, std NULL -> 0).

    Moments and extremes are built-in frame aggregates; the three quantiles of
    a frame come from one sorted frame array (k <= 12 values) instead of three
    per-row ``percentile`` re-aggregations.
    """
    q = F.col("sales_quantity")
    cols = []
    for k in windows:
        fr = frame(k, entity)
        mean = F.avg(q).over(fr)
        std = F.coalesce(F.stddev_samp(q).over(fr), F.lit(0.0))
        cols += [mean.alias(f"sales_rolling_mean_{k}"), std.alias(f"sales_rolling_std_{k}"),
                 F.min(q).over(fr).alias(f"sales_rolling_min_{k}"),
                 F.max(q).over(fr).alias(f"sales_rolling_max_{k}"),
                 (std / (mean + 1)).alias(f"sales_rolling_cv_{k}")]
    # one ordered frame array of the longest window; shorter windows are its tail
    cols.append(F.collect_list(q).over(frame(max(windows), entity)).alias("_frame"))
    df = df.select("*", *cols)
    arr, n = F.col("_frame"), F.size(F.col("_frame"))
    # sorted tails as their own columns: each is reused by three quantiles
    df = df.select("*", *[F.sort_array(F.slice(arr, F.greatest(n - k + 1, F.lit(1)), F.lit(k))).alias(f"_sorted_{k}")
                          for k in windows])
    qs = []
    for k in windows:
        srt = F.col(f"_sorted_{k}")
        qs += [sorted_quantile(srt, 0.5).alias(f"sales_rolling_median_{k}"),
               sorted_quantile(srt, 0.25).alias(f"sales_rolling_q25_{k}"),
               sorted_quantile(srt, 0.75).alias(f"sales_rolling_q75_{k}")]
    return df.select("*", *qs).drop("_frame", *[f"_sorted_{k}" for k in windows])


def momentum_features(df: DataFrame, entity=ENTITY) -> DataFrame:
    """Mom change (+-inf kept), abs change, OLS trend 3/6, acceleration,
    volatility 3/6 (reused from the rolling std when present), momentum flags."""
    w = entity_window(entity)
    q = F.col("sales_quantity")
    prev = F.lag(q, 1).over(w)
    mom = F.coalesce(pct_change(q, prev), F.lit(0.0))
    df = df.withColumn("_rn", F.row_number().over(w).cast("double"))
    rn = F.col("_rn")
    vol = [F.col(f"sales_rolling_std_{k}") if f"sales_rolling_std_{k}" in df.columns
           else F.coalesce(F.stddev_samp(q).over(frame(k, entity)), F.lit(0.0)) for k in (3, 6)]
    df = df.select("*", mom.alias("sales_mom_change"),
                   F.coalesce(q - prev, F.lit(0.0)).alias("sales_mom_abs_change"),
                   *[F.coalesce(F.regr_slope(q, rn).over(frame(k, entity)), F.lit(0.0))
                     .alias(f"sales_trend_{k}m") for k in (3, 6)],
                   vol[0].alias("sales_volatility_3m"), vol[1].alias("sales_volatility_6m"))
    m = F.col("sales_mom_change")
    accel = F.coalesce(_finite_diff(m, F.lag(m, 1).over(w)), F.lit(0.0))
    return df.select("*", accel.alias("sales_acceleration"),
                     flag(m > 0.1).alias("momentum_up"), flag(m < -0.1).alias("momentum_down"),
                     flag((m >= -0.1) & (m <= 0.1)).alias("momentum_stable")).drop("_rn")


def rolling_and_momentum(df: DataFrame, windows=ROLL, entity=ENTITY) -> DataFrame:
    """W3-W11 in one pass over the entity window (volatility reuses the rolling std)."""
    return momentum_features(rolling_features(df, windows, entity), entity)


def _finite_diff(cur, prev):
    """x - lag(x); inf - inf (NaN in pandas) -> NULL."""
    d = cur - prev
    return F.when(~F.isnan(d), d)


def yoy_lags(df: DataFrame, entity=ENTITY) -> DataFrame:
    """Change against 12 rows before, and its trend flags."""
    q = F.col("sales_quantity")
    yoy = F.lag(q, 12).over(entity_window(entity))
    growth = F.coalesce((q - yoy) / (yoy + 1), F.lit(0.0))
    df = df.select("*", yoy.alias("sales_yoy"), growth.alias("sales_yoy_growth"),
                   F.coalesce(pct_change(q, yoy), F.lit(0.0)).alias("sales_yoy_pct_change"))
    g = F.col("sales_yoy_growth")
    return df.select("*", flag(g > 0.1).alias("yoy_trend_up"), flag(g < -0.1).alias("yoy_trend_down"),
                     flag((g >= -0.1) & (g <= 0.1)).alias("yoy_trend_stable"))


def seasonal_consistency(df: DataFrame, entity=ENTITY, source: DataFrame | None = None) -> DataFrame:
    """Per entity and calendar month, std / (mean + 1) if there are two rows."""
    q = F.col("sales_quantity")
    src = (df if source is None else source).withColumn("_moy", F.month("sales_month"))
    return with_group_stats(df.withColumn("_moy", F.month("sales_month")), [*entity, "_moy"], [
        F.coalesce(F.when(F.count(q) > 1, F.stddev_samp(q) / (F.avg(q) + 1)), F.lit(0.0)).alias("seasonal_consistency")],
        src).drop("_moy")


def advanced_momentum(df: DataFrame, entity=ENTITY) -> DataFrame:
    """momentum_{2,3,6}m, trend_consistency_3m, momentum_acceleration.

    Needs ``sales_mom_change`` (W6).  A rolling window of 3 needs three finite
    values (pandas skips infinities), otherwise 0.
    """
    w = entity_window(entity)
    q = F.col("sales_quantity")
    df = df.select("*", *[F.coalesce(pct_change(q, F.lag(q, k).over(w)), F.lit(0.0)).alias(f"momentum_{k}m")
                          for k in (2, 3, 6)])
    m2 = F.col("momentum_2m")
    fr = frame(3, entity)
    n_finite = F.sum(finite(m2).cast("int")).over(fr)
    pos = F.sum((finite(m2) & (m2 > 0)).cast("int")).over(fr)
    tc = F.when(n_finite == 3, pos / 3.0).otherwise(F.lit(0.0))
    mc = F.col("sales_mom_change")
    acc = F.coalesce(_finite_diff(mc, F.lag(mc, 1).over(w)), F.lit(0.0))
    return df.select("*", tc.alias("trend_consistency_3m"), acc.alias("momentum_acceleration"))


#: Integer columns of ``spike_features``, all of them flags (0 or 1).
SPIKE_FLAGS = ("sales_spike_major", "sales_spike_moderate", "sales_drop_major", "sales_drop_moderate")


def with_z_scores(df: DataFrame, entity=ENTITY, source: DataFrame | None = None):
    """(``df`` with the mean and deviation of its entity and the z-score of its quantity, the
    persisted table of both, whether it is small enough to be broadcast)."""
    q = F.col("sales_quantity")
    src = df if source is None else source
    stats = src.groupBy(*entity).agg(F.avg(q).alias("_e_mean"), F.stddev_samp(q).alias("_e_std"))
    from .behaviour import combined, join_back
    stats, small = combined([stats], entity)
    z = (q - F.col("_e_mean")) / (F.col("_e_std") + 1e-6)
    return join_back(df, stats, entity, broadcast=small).withColumn("sales_z_score", z), stats, small


def spike_features(df: DataFrame, entity=ENTITY, source: DataFrame | None = None) -> DataFrame:
    """Entity z-score, spike flags, ma3 deviation, spike propensity."""
    q = F.col("sales_quantity")
    src = df if source is None else source
    df, stats, small = with_z_scores(df, entity, src)
    # the 3-row mean with min_periods=1 is the rolling mean of W3 when already present
    ma3 = F.col("sales_rolling_mean_3") if "sales_rolling_mean_3" in df.columns else F.avg(q).over(frame(3, entity))
    df = df.select("*", ma3.alias("sales_ma_3")).drop("_e_mean", "_e_std")
    zc = F.col("sales_z_score")
    df = df.select("*", flag(zc > 2.5).alias("sales_spike_major"),
                   flag((zc > 1.5) & (zc <= 2.5)).alias("sales_spike_moderate"),
                   flag(zc < -2.5).alias("sales_drop_major"),
                   flag((zc < -1.5) & (zc >= -2.5)).alias("sales_drop_moderate"),
                   ((q - F.col("sales_ma_3")) / (F.col("sales_ma_3") + 1)).alias("sales_deviation_from_ma"))
    # propensity from the source rows: z per row via the small stats table, then an aggregate
    zs = (q - F.col("_e_mean")) / (F.col("_e_std") + 1e-6)
    flagged = src.select(*entity, "sales_quantity").join(F.broadcast(stats) if small else stats, list(entity)).select(
        *entity, flag(zs > 2.5).alias("_maj"), flag((zs > 1.5) & (zs <= 2.5)).alias("_mod"))
    return with_group_stats(df, entity, [(F.avg("_maj") + 0.5 * F.avg("_mod")).alias("spike_propensity_score")],
                            flagged)


# ---------------------------------------------------------------- v1 windows --

def lags_v1(df: DataFrame, k_max=3, entity=ENTITY, name="sales_lag_v1") -> DataFrame:
    """Plain quantity lags 1..k (NULL kept, filled later by P12)."""
    w = entity_window(entity)
    return df.select("*", *[F.lag("sales_quantity", k).over(w).alias(f"{name}_{k}") for k in range(1, k_max + 1)])


def momentum_v1(df: DataFrame, entity=ENTITY) -> DataFrame:
    """Pct change 1/3/6, momentum short/long, acceleration, volatility ratio,
    deviation and rolling z against the 6-row window (v1 names)."""
    w = entity_window(entity)
    q = F.col("sales_quantity")
    mean = {k: F.avg(q).over(frame(k, entity)) for k in (3, 6, 12)}
    std6 = F.coalesce(F.stddev_samp(q).over(frame(6, entity)), F.lit(0.0))
    cols = [F.coalesce(pct_change(q, F.lag(q, k).over(w)), F.lit(0.0)).alias(f"sales_pct_change_{k}")
            for k in (1, 3, 6)]
    cols += [F.when(mean[3] != 0, mean[6] / mean[3]).otherwise(1.0).alias("sales_momentum_short"),
             F.when(mean[6] != 0, mean[12] / mean[6]).otherwise(1.0).alias("sales_momentum_long"),
             F.when(mean[6] != 0, std6 / mean[6]).otherwise(0.0).alias("sales_volatility_ratio"),
             F.when(mean[6] > 0, (q - mean[6]) / mean[6]).otherwise(0.0).alias("deviation_from_rolling_mean"),
             F.when(std6 > 0, (q - mean[6]) / std6).otherwise(0.0).alias("rolling_z_score")]
    df = df.select("*", *cols)
    pc1 = F.col("sales_pct_change_1")
    return df.withColumn("sales_acceleration_v1",
                         F.coalesce(_finite_diff(pc1, F.lag(pc1, 1).over(w)), F.lit(0.0)))


def spike_history(df: DataFrame, q95: float, q99: float, entity=ENTITY) -> DataFrame:
    """A43 + W24: global q95/q99 spike flags, per-entity spike totals, running propensity."""
    q = F.col("sales_quantity")
    df = df.select("*", flag(q > F.lit(q99)).alias("is_extreme_spike"),
                   flag(q > F.lit(q95)).alias("is_major_spike"))
    df = with_group_stats(df, entity, [F.sum("is_extreme_spike").alias("historical_extreme_spikes"),
                                       F.sum("is_major_spike").alias("historical_major_spikes")])
    from .scans import running_number
    return (running_number(df, "_number", entity)
            .withColumn("spike_propensity", F.col("historical_major_spikes") / F.col("_number")).drop("_number"))


def strict_rolling_mean(df: DataFrame, k=3, entity=ENTITY) -> DataFrame:
    """Mean of exactly k rows, else 0."""
    fr = frame(k, entity)
    return df.withColumn(f"rolling_mean_{k}_strict",
                         F.when(F.count("sales_quantity").over(fr) == k, F.avg("sales_quantity").over(fr))
                         .otherwise(0.0))


def group_diff(df: DataFrame, value: str, keys, out: str, order=ORDER) -> DataFrame:
    """Per-key diff or pct change (+-inf -> 0), NULL -> 0."""
    from .scans import previous
    df = previous(df, value, "_before", keys, order)
    return df.withColumn(out, F.coalesce(F.col(value) - F.col("_before"), F.lit(0.0))).drop("_before")


def group_pct_change(df: DataFrame, value: str, keys, out: str, order=ORDER) -> DataFrame:
    from .scans import previous
    pc = pct_change(F.col(value), F.col("_before"))
    return previous(df, value, "_before", keys, order).withColumn(out, F.when(finite(pc), pc).otherwise(0.0)).drop("_before")


def forward_fill(df: DataFrame, cols, entity=ENTITY) -> DataFrame:
    """Last non-null value so far within the entity."""
    from .scans import last_known
    return last_known(df, list(cols), entity)


def fill_v1(df: DataFrame, entity=ENTITY) -> DataFrame:
    """Lags ffill then 0; rolling mean/min/max -> q; rolling std -> 0."""
    lag_cols = [c for c in df.columns if "_lag_" in c]
    df = forward_fill(df, lag_cols, entity)
    out = []
    for c in df.columns:
        if c in lag_cols:
            out.append(F.coalesce(F.col(c), F.lit(0.0)).alias(c))
        elif "rolling_std" in c:
            out.append(F.coalesce(F.col(c), F.lit(0.0)).alias(c))
        elif any(s in c for s in ("rolling_mean", "rolling_min", "rolling_max")):
            out.append(F.coalesce(F.col(c), F.col("sales_quantity")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def gap_detection(df: DataFrame, max_gap_days=62, entity=ENTITY) -> DataFrame:
    """Per entity, number of consecutive-date gaps > max_gap_days and the largest gap."""
    w = Window.partitionBy(*entity).orderBy("sales_month")
    d = df.select(*entity, "sales_month").distinct()
    d = d.withColumn("_gap", F.datediff("sales_month", F.lag("sales_month").over(w)))
    big = F.col("_gap") > max_gap_days
    return (d.where(big).groupBy(*entity)
             .agg(F.count("*").alias("gap_count"), F.max("_gap").alias("max_gap_days")))

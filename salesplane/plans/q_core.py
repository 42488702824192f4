"""Registered queries: scans, cleaning, calendar and per-entity windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar as cal
from ..operators import skew
from ..operators import temporal as tp
from ..sources.tpch import daily_calendar
from .base import D, R, base, finalize, sales, sales_cte, with_base, with_base_ctes
from .catalog import register

E = "primary_platform, store_name, brand_name"
WE = f"PARTITION BY {E} ORDER BY sales_month, product_code"


def _cols(names, keys=()):
    """SQL select list: keys as is, doubles rounded."""
    return ", ".join(list(keys) + [f"{R(n)} AS {n}" for n in names])


# ---------------------------------------------------------------- S / P ------

register("s_sales_view", f"""WITH {sales_cte()}
SELECT {D('sales_month')} AS sales_month, primary_platform, secondary_platform, store_name, brand_name,
       product_code, {R('sales_amount')} AS sales_amount, {R('sales_quantity')} AS sales_quantity FROM sales""")(
    lambda spark, d: finalize(sales(spark, d)))

register("s_sales_sparse", f"""WITH {sales_cte(True)}
SELECT {D('sales_month')} AS sales_month, primary_platform, secondary_platform, store_name, brand_name,
       product_code, {R('sales_amount')} AS sales_amount, {R('sales_quantity')} AS sales_quantity FROM sales""")(
    lambda spark, d: finalize(sales(spark, d, sparse=True)))


@register("p_base_setup", with_base(f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code,
       {_cols(['unit_price', 'sales_quantity_log'])},
       has_missing_price, has_zero_sales, has_high_price FROM base"""))
def p_base_setup(spark, d):
    """P4 unit price, P8 log target, P9 quality flags."""
    b = base(spark, d)
    return finalize(b.select("sales_month", *tp.ENTITY, "product_code", "unit_price",
                             "sales_quantity_log", "has_missing_price", "has_zero_sales", "has_high_price"))


# ---------------------------------------------------------------- W ----------

def _lag_sql(k):
    return ", ".join(f"{R(f'coalesce(lag({src}, {k}) OVER w, 0)')} AS {dst}_lag_{k}"
                     for src, dst in (("sales_quantity", "sales"), ("sales_amount", "amount"),
                                      ("unit_price", "price")))


@register("w1_lags", with_base(f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code, {', '.join(_lag_sql(k) for k in tp.LAGS)}
FROM base WINDOW w AS ({WE})"""))
def w1_lags(spark, d):
    b = base(spark, d)
    out = skew.chunked(b, lambda x, e: tp.lag_features(x, entity=e))
    return finalize(out.select("sales_month", *tp.ENTITY, "product_code",
                               *[f"{p}_lag_{k}" for k in tp.LAGS for p in ("sales", "amount", "price")]))


def _roll_sql(k):
    fr = f"w{k}"
    q = "sales_quantity"
    mean, std = f"avg({q}) OVER {fr}", f"coalesce(stddev_samp({q}) OVER {fr}, 0)"
    return ", ".join([
        f"{R(mean)} AS sales_rolling_mean_{k}", f"{R(std)} AS sales_rolling_std_{k}",
        f"{R(f'min({q}) OVER {fr}')} AS sales_rolling_min_{k}",
        f"{R(f'max({q}) OVER {fr}')} AS sales_rolling_max_{k}",
        f"{R(f'{std} / ({mean} + 1)')} AS sales_rolling_cv_{k}",
        f"{R(f'quantile_cont({q}, 0.5) OVER {fr}')} AS sales_rolling_median_{k}",
        f"{R(f'quantile_cont({q}, 0.25) OVER {fr}')} AS sales_rolling_q25_{k}",
        f"{R(f'quantile_cont({q}, 0.75) OVER {fr}')} AS sales_rolling_q75_{k}"])


ROLL_COLS = [f"sales_rolling_{s}_{k}" for k in tp.ROLL
             for s in ("mean", "std", "min", "max", "cv", "median", "q25", "q75")]


@register("w3_rolling_stats", with_base(f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code, {', '.join(_roll_sql(k) for k in tp.ROLL)}
FROM base WINDOW {', '.join(f'w{k} AS ({WE} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)' for k in tp.ROLL)}"""))
def w3_rolling(spark, d):
    """W3-W5."""
    out = skew.chunked(base(spark, d), lambda x, e: tp.rolling_features(x, entity=e))
    return finalize(out.select("sales_month", *tp.ENTITY, "product_code", *ROLL_COLS))


def _pct_sql(cur, prev):
    return (f"(CASE WHEN ({prev}) IS NULL OR ({cur}) IS NULL THEN NULL "
            f"WHEN ({prev}) = 0 THEN (CASE WHEN ({cur}) > 0 THEN 'Infinity'::DOUBLE "
            f"WHEN ({cur}) < 0 THEN '-Infinity'::DOUBLE END) "
            f"ELSE (({cur}) - ({prev})) / ({prev}) END)")


KEYS_SQL = f"{D('sales_month')} AS sales_month, {E}, product_code"
KEYS = ["sales_month", *tp.ENTITY, "product_code"]

MOM_COLS = ["sales_mom_change", "sales_mom_abs_change", "sales_trend_3m", "sales_trend_6m",
            "sales_volatility_3m", "sales_volatility_6m", "sales_acceleration"]
MOM_FLAGS = ["momentum_up", "momentum_down", "momentum_stable"]


@register("w6_momentum", with_base_ctes(f"""
r AS (SELECT *, CAST(row_number() OVER ({WE}) AS DOUBLE) AS rn,
              coalesce({_pct_sql('sales_quantity', f'lag(sales_quantity) OVER ({WE})')}, 0) AS mom,
              coalesce(sales_quantity - lag(sales_quantity) OVER ({WE}), 0) AS absch
        FROM base),
s AS (SELECT *,
        CASE WHEN count(*) OVER f3 < 2 THEN 0 ELSE coalesce(regr_slope(sales_quantity, rn) OVER f3, 0) END AS tr3,
        CASE WHEN count(*) OVER f6 < 2 THEN 0 ELSE coalesce(regr_slope(sales_quantity, rn) OVER f6, 0) END AS tr6,
        coalesce(stddev_samp(sales_quantity) OVER f3, 0) AS v3,
        coalesce(stddev_samp(sales_quantity) OVER f6, 0) AS v6,
        coalesce(CASE WHEN isnan(mom - lag(mom) OVER ({WE})) THEN NULL ELSE mom - lag(mom) OVER ({WE}) END, 0) AS acc
      FROM r WINDOW f3 AS ({WE} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
                    f6 AS ({WE} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))""", f"""
SELECT {KEYS_SQL}, {R('mom')} AS sales_mom_change, {R('absch')} AS sales_mom_abs_change,
       {R('tr3')} AS sales_trend_3m, {R('tr6')} AS sales_trend_6m,
       {R('v3')} AS sales_volatility_3m, {R('v6')} AS sales_volatility_6m, {R('acc')} AS sales_acceleration,
       CAST(mom > 0.1 AS INTEGER) AS momentum_up, CAST(mom < -0.1 AS INTEGER) AS momentum_down,
       CAST(mom >= -0.1 AND mom <= 0.1 AS INTEGER) AS momentum_stable FROM s"""))
def w6_momentum(spark, d):
    """W6-W11."""
    out = skew.chunked(base(spark, d), lambda x, e: tp.momentum_features(x, entity=e))
    return finalize(out.select(*KEYS, *MOM_COLS, *MOM_FLAGS))


def _f(k):
    return f"({WE} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _nan0(expr):
    return f"coalesce(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END, 0)"


@register("w12_yoy", with_base(f"""
SELECT {KEYS_SQL}, {R('y')} AS sales_yoy, {R('g')} AS sales_yoy_growth, {R('pc')} AS sales_yoy_pct_change,
       {R('sc')} AS seasonal_consistency,
       CAST(g > 0.1 AS INTEGER) AS yoy_trend_up, CAST(g < -0.1 AS INTEGER) AS yoy_trend_down,
       CAST(g >= -0.1 AND g <= 0.1 AS INTEGER) AS yoy_trend_stable
FROM (SELECT *, coalesce((sales_quantity - y) / (y + 1), 0) AS g,
             coalesce({_pct_sql('sales_quantity', 'y')}, 0) AS pc
      FROM (SELECT *, lag(sales_quantity, 12) OVER ({WE}) AS y,
                   coalesce(CASE WHEN count(sales_quantity) OVER wm > 1
                            THEN stddev_samp(sales_quantity) OVER wm / (avg(sales_quantity) OVER wm + 1)
                            ELSE 0 END, 0) AS sc
            FROM base WINDOW wm AS (PARTITION BY {E}, month(sales_month))))"""))
def w12_yoy(spark, d):
    """W12-W13."""
    b = base(spark, d)
    out = tp.seasonal_consistency(skew.chunked(b, lambda x, e: tp.yoy_lags(x, entity=e)), source=b)
    return finalize(out.select(*KEYS, "sales_yoy", "sales_yoy_growth", "sales_yoy_pct_change",
                               "seasonal_consistency", "yoy_trend_up", "yoy_trend_down", "yoy_trend_stable"))


@register("w14_momentum_advanced", with_base(f"""
SELECT {KEYS_SQL}, {R('m2')} AS momentum_2m, {R('m3')} AS momentum_3m, {R('m6')} AS momentum_6m,
       {R('tc')} AS trend_consistency_3m, {R('ma')} AS momentum_acceleration
FROM (SELECT *,
        CASE WHEN sum(CASE WHEN isfinite(m2) THEN 1 ELSE 0 END) OVER {_f(3)} = 3
             THEN sum(CASE WHEN isfinite(m2) AND m2 > 0 THEN 1 ELSE 0 END) OVER {_f(3)} / 3.0 ELSE 0 END AS tc,
        {_nan0(f'mom - lag(mom) OVER ({WE})')} AS ma
      FROM (SELECT *, coalesce({_pct_sql('sales_quantity', f'lag(sales_quantity) OVER ({WE})')}, 0) AS mom,
                   coalesce({_pct_sql('sales_quantity', f'lag(sales_quantity, 2) OVER ({WE})')}, 0) AS m2,
                   coalesce({_pct_sql('sales_quantity', f'lag(sales_quantity, 3) OVER ({WE})')}, 0) AS m3,
                   coalesce({_pct_sql('sales_quantity', f'lag(sales_quantity, 6) OVER ({WE})')}, 0) AS m6
            FROM base))"""))
def w14_momentum_advanced(spark, d):
    """W14-W16."""
    out = skew.chunked(base(spark, d), lambda x, e: tp.advanced_momentum(tp.momentum_features(x, entity=e), entity=e))
    return finalize(out.select(*KEYS, "momentum_2m", "momentum_3m", "momentum_6m",
                               "trend_consistency_3m", "momentum_acceleration"))


@register("w17_spikes", with_base(f"""
SELECT {KEYS_SQL}, {R('z')} AS sales_z_score, {R('ma3')} AS sales_ma_3,
       sales_spike_major, sales_spike_moderate, sales_drop_major, sales_drop_moderate,
       {R('(sales_quantity - ma3) / (ma3 + 1)')} AS sales_deviation_from_ma,
       {R(f'avg(sales_spike_major) OVER (PARTITION BY {E}) + 0.5 * avg(sales_spike_moderate) OVER (PARTITION BY {E})')}
         AS spike_propensity_score
FROM (SELECT *, CAST(coalesce(z > 2.5, false) AS INTEGER) AS sales_spike_major,
             CAST(coalesce(z > 1.5 AND z <= 2.5, false) AS INTEGER) AS sales_spike_moderate,
             CAST(coalesce(z < -2.5, false) AS INTEGER) AS sales_drop_major,
             CAST(coalesce(z < -1.5 AND z >= -2.5, false) AS INTEGER) AS sales_drop_moderate
      FROM (SELECT *, (sales_quantity - avg(sales_quantity) OVER (PARTITION BY {E}))
                      / (stddev_samp(sales_quantity) OVER (PARTITION BY {E}) + 1e-6) AS z,
                   avg(sales_quantity) OVER {_f(3)} AS ma3 FROM base))"""))
def w17_spikes(spark, d):
    """W17-W19, A34."""
    b = base(spark, d)
    out = tp.spike_features(skew.chunked(b, lambda x, e: tp.rolling_features(x, [3], entity=e)), source=b)
    return finalize(out.select(*KEYS, "sales_z_score", "sales_ma_3", "sales_spike_major",
                               "sales_spike_moderate", "sales_drop_major", "sales_drop_moderate",
                               "sales_deviation_from_ma", "spike_propensity_score"))


@register("w2_lags_v1", with_base(f"""
SELECT {KEYS_SQL}, {', '.join(f"{R(f'lag(sales_quantity, {k}) OVER ({WE})')} AS sales_lag_v1_{k}" for k in (1, 2, 3))}
FROM base"""))
def w2_lags_v1(spark, d):
    out = skew.chunked(base(spark, d), lambda x, e: tp.lags_v1(x, entity=e))
    return finalize(out.select(*KEYS, *[f"sales_lag_v1_{k}" for k in (1, 2, 3)]))


V1_MOM = ["sales_pct_change_1", "sales_pct_change_3", "sales_pct_change_6", "sales_momentum_short",
          "sales_momentum_long", "sales_volatility_ratio", "deviation_from_rolling_mean", "rolling_z_score",
          "sales_acceleration_v1"]


@register("w20_momentum_v1", with_base(f"""
SELECT {KEYS_SQL}, {R('p1')} AS sales_pct_change_1, {R('p3')} AS sales_pct_change_3, {R('p6')} AS sales_pct_change_6,
       {R('CASE WHEN m3 <> 0 THEN m6 / m3 ELSE 1 END')} AS sales_momentum_short,
       {R('CASE WHEN m6 <> 0 THEN m12 / m6 ELSE 1 END')} AS sales_momentum_long,
       {R('CASE WHEN m6 <> 0 THEN s6 / m6 ELSE 0 END')} AS sales_volatility_ratio,
       {R('CASE WHEN m6 > 0 THEN (sales_quantity - m6) / m6 ELSE 0 END')} AS deviation_from_rolling_mean,
       {R('CASE WHEN s6 > 0 THEN (sales_quantity - m6) / s6 ELSE 0 END')} AS rolling_z_score,
       {R(_nan0(f'p1 - lag(p1) OVER ({WE})'))} AS sales_acceleration_v1
FROM (SELECT *, avg(sales_quantity) OVER {_f(3)} AS m3, avg(sales_quantity) OVER {_f(6)} AS m6,
             avg(sales_quantity) OVER {_f(12)} AS m12, coalesce(stddev_samp(sales_quantity) OVER {_f(6)}, 0) AS s6,
             {', '.join(f"coalesce({_pct_sql('sales_quantity', f'lag(sales_quantity, {k}) OVER ({WE})')}, 0) AS p{k}" for k in (1, 3, 6))}
      FROM base)"""))
def w20_momentum_v1(spark, d):
    """W20-W23."""
    out = skew.chunked(base(spark, d), lambda x, e: tp.momentum_v1(x, entity=e))
    return finalize(out.select(*KEYS, *V1_MOM))


@register("w25_strict_rolling_mean", with_base(f"""
SELECT {KEYS_SQL}, {R(f'CASE WHEN count(sales_quantity) OVER {_f(3)} = 3 THEN avg(sales_quantity) OVER {_f(3)} ELSE 0 END')}
       AS rolling_mean_3_strict FROM base"""))
def w25_strict(spark, d):
    out = skew.chunked(base(spark, d), lambda x, e: tp.strict_rolling_mean(x, entity=e))
    return finalize(out.select(*KEYS, "rolling_mean_3_strict"))


@register("w31_gap_detection", with_base(f"""
SELECT {E}, CAST(count(*) AS BIGINT) AS gap_count, max(g) AS max_gap_days
FROM (SELECT {E}, CAST(sales_month - lag(sales_month) OVER (PARTITION BY {E} ORDER BY sales_month) AS INTEGER) AS g
      FROM (SELECT DISTINCT {E}, sales_month FROM base))
WHERE g > 62 GROUP BY {E}"""))
def w31_gaps(spark, d):
    return finalize(tp.gap_detection(base(spark, d)))


CAL_PARTS = ["month", "quarter", "year", "day_of_year", "week_of_year", "days_since_epoch"]
CAL_DBL = ["month_progress", "quarter_progress", "month_sin", "month_cos", "quarter_sin", "quarter_cos",
           "day_of_year_sin", "day_of_year_cos", "week_sin", "week_cos"]
CAL_FLAGS = ["is_holiday_season", "is_mid_year_shopping", "is_back_to_school"]


@register("t1_calendar_parts", with_base(f"""
SELECT {KEYS_SQL}, month, quarter, year, day_of_year, week_of_year, days_since_epoch,
       {R('(month - 1) / 11')} AS month_progress, {R('(quarter - 1) / 3')} AS quarter_progress,
       {R('sin(2 * pi() * (month - 1) / 12)')} AS month_sin, {R('cos(2 * pi() * (month - 1) / 12)')} AS month_cos,
       {R('sin(2 * pi() * (quarter - 1) / 4)')} AS quarter_sin, {R('cos(2 * pi() * (quarter - 1) / 4)')} AS quarter_cos,
       {R('sin(2 * pi() * day_of_year / 365.25)')} AS day_of_year_sin,
       {R('cos(2 * pi() * day_of_year / 365.25)')} AS day_of_year_cos,
       {R('sin(2 * pi() * week_of_year / 52)')} AS week_sin, {R('cos(2 * pi() * week_of_year / 52)')} AS week_cos,
       CAST(month IN (12, 1, 2) AS INTEGER) AS is_holiday_season,
       CAST(month IN (6, 7) AS INTEGER) AS is_mid_year_shopping,
       CAST(month IN (8, 9) AS INTEGER) AS is_back_to_school
FROM (SELECT *, CAST(month(sales_month) AS INTEGER) AS month, CAST(quarter(sales_month) AS INTEGER) AS quarter,
             CAST(year(sales_month) AS INTEGER) AS year, CAST(dayofyear(sales_month) AS INTEGER) AS day_of_year,
             CAST(weekofyear(sales_month) AS INTEGER) AS week_of_year,
             CAST(sales_month - DATE '2021-01-01' AS INTEGER) AS days_since_epoch FROM base)"""))
def t1_calendar_parts(spark, d):
    out = tp.calendar_parts(base(spark, d))
    return finalize(out.select(*KEYS, *CAL_PARTS, *CAL_DBL, *CAL_FLAGS))


PROMO_V1 = ["is_promo_month", "months_to_promo", "distance_to_nearest_promo", "distance_to_next_promo",
            "is_pre_promo_month", "season_group", "season_spring_summer", "season_summer", "season_fall",
            "season_winter_holiday", "season_other"]


@register("t7_promo_months_v1", with_base(f"""
SELECT {KEYS_SQL}, CAST(m IN (1, 6, 9, 11, 12) AS INTEGER) AS is_promo_month,
       CAST(list_min([least(abs(m - p), 12 - abs(m - p)) FOR p IN [1, 6, 9, 11, 12]]) AS INTEGER) AS months_to_promo,
       CAST(list_min([abs(m - p) FOR p IN [1, 6, 9, 11, 12]]) AS INTEGER) AS distance_to_nearest_promo,
       CAST(coalesce(list_min([p FOR p IN [1, 6, 9, 11, 12] IF p > m]) - m, 12 - m + 1) AS INTEGER) AS distance_to_next_promo,
       CAST(m IN (12, 5, 8, 10, 11) AS INTEGER) AS is_pre_promo_month, sg AS season_group,
       CAST(sg = 'spring_summer' AS INTEGER) AS season_spring_summer, CAST(sg = 'summer' AS INTEGER) AS season_summer,
       CAST(sg = 'fall' AS INTEGER) AS season_fall, CAST(sg = 'winter_holiday' AS INTEGER) AS season_winter_holiday,
       CAST(sg = 'other' AS INTEGER) AS season_other
FROM (SELECT *, CASE WHEN m IN (4, 5, 6) THEN 'spring_summer' WHEN m IN (7, 8) THEN 'summer'
                     WHEN m IN (9, 10) THEN 'fall' WHEN m IN (11, 12) THEN 'winter_holiday' ELSE 'other' END AS sg
      FROM (SELECT *, CAST(month(sales_month) AS INTEGER) AS m FROM base))"""))
def t7_promo_months(spark, d):
    b = base(spark, d).withColumn("month", F.month("sales_month"))
    out = tp.promo_month_features(b)
    return finalize(out.select(*KEYS, *PROMO_V1))


# ---------------------------------------------------------------- C ----------

CAL_EVENT_COLS = [cal.event_column(n) for n, *_ in cal.K.PROMO_EVENTS]
CAL_OUT = (["is_promotional_period"] + CAL_EVENT_COLS
           + ["days_to_next_promo", "days_from_last_promo", "true_days_since_last_promo",
              "promotional_intensity", "monthly_promo_score"]
           + ["is_" + n.lower().replace(" ", "_") for n, *_ in cal.K.SEASONS])


def _anchor_values():
    rows = []
    for i, (_, dates, dur, inten) in enumerate(cal.K.PROMO_EVENTS):
        for m, dd in dates:
            rows.append(f"({i}, {m}, {dd}, {float(dur)}, {float(inten)})")
    return ", ".join(rows)


def _calendar_sql(dates_sql: str) -> str:
    ev = ", ".join(
        f'CAST(bool_or(ev = {i} AND 2 * abs(d - make_date(year(d), am, ad)) <= dur) AS INTEGER) AS "{c}"'
        for i, c in enumerate(CAL_EVENT_COLS))
    season = " , ".join(f"CASE WHEN month(d) IN ({', '.join(map(str, ms))}) THEN {inten * 0.3} ELSE 0 END"
                        for _, ms, inten in cal.K.SEASONS)
    seasons = ", ".join(f"CAST(month(d) IN ({', '.join(map(str, ms))}) AS INTEGER) AS is_{n.lower().replace(' ', '_')}"
                        for n, ms, _ in cal.K.SEASONS)
    score = " ".join(f"WHEN {i + 1} THEN {v}" for i, v in enumerate(cal.K.MONTHLY_PROMO_SCORE))
    return f"""
dates AS ({dates_sql}),
anchors(ev, am, ad, dur, inten) AS (VALUES {_anchor_values()}),
x AS (SELECT d, ev, dur, inten,
             CAST(d - make_date(year(d), am, ad) AS INTEGER) AS df0,
             CAST(d - make_date(year(d) + 1, am, ad) AS INTEGER) AS dfn,
             CAST(d - make_date(year(d) - 1, am, ad) AS INTEGER) AS dfp, am, ad
      FROM dates, anchors),
c AS (SELECT d,
        CAST(bool_or(2 * abs(df0) <= dur) AS INTEGER) AS is_promotional_period, {ev},
        min(CASE WHEN df0 < 0 THEN -df0 END) AS ahead, min(-dfn) AS ahead_next,
        coalesce(max(CASE WHEN df0 > 0 THEN df0 END), 0) AS behind,
        coalesce(max(CASE WHEN dfp > 0 THEN dfp END), 0) AS behind_prev,
        least(min(CASE WHEN df0 > 0 THEN df0 END), min(CASE WHEN dfp > 0 THEN dfp END)) AS since_last,
        max(CASE WHEN 2 * abs(df0) <= dur THEN inten * greatest(0, 1 - abs(df0) / (dur / 2)) ELSE 0 END) AS peak
      FROM x GROUP BY d)
SELECT {D('d')} AS d, is_promotional_period, {', '.join(f'"{c}"' for c in CAL_EVENT_COLS)},
       CAST(CASE WHEN least(coalesce(ahead, 365), 365) = 365 THEN least(ahead_next, 365)
            ELSE least(coalesce(ahead, 365), 365) END AS INTEGER) AS days_to_next_promo,
       CAST(least(CASE WHEN behind = 0 AND month(d) <= 6 THEN behind_prev ELSE behind END, 365) AS INTEGER)
         AS days_from_last_promo,
       CAST(least(since_last, 365) AS INTEGER) AS true_days_since_last_promo,
       {R(f'least(greatest(peak, {season}), 1.0)')} AS promotional_intensity,
       {R(f'CASE month(d) {score} ELSE 0.4 END')} AS monthly_promo_score, {seasons}
FROM c"""


@register("c1_calendar_daily", f"WITH {_calendar_sql('SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(range AS DATE) FROM range(DATE 2000-01-01, DATE 2001-01-01, INTERVAL 1 DAY)'.replace('DATE 2000-01-01', chr(39) + '2000-01-01' + chr(39) + '::DATE').replace('DATE 2001-01-01', chr(39) + '2001-01-01' + chr(39) + '::DATE'))}")
def c1_calendar_daily(spark, d):
    dates = daily_calendar(spark, d)
    return finalize(cal.calendar_features(dates, "d").select("d", *CAL_OUT))


@register("c8_calendar_on_sales", with_base_ctes(_calendar_sql("SELECT DISTINCT sales_month AS d FROM base"), ""))
def c8_calendar_on_sales(spark, d):
    b = base(spark, d)
    dates = b.select(F.col("sales_month").alias("d")).distinct()
    return finalize(cal.calendar_features(dates, "d").select("d", *CAL_OUT))


# ---------------------------------------------------------------- flagship ---

@register("flagship_share_trend", with_base_ctes(f"""
bs AS (SELECT b.primary_platform, b.brand_name, sum(sales_quantity) / any_value(pt) AS share
       FROM base b JOIN (SELECT primary_platform, sum(sales_quantity) AS pt FROM base GROUP BY 1) p
            USING (primary_platform) GROUP BY 1, 2)""", f"""
SELECT {KEYS_SQL}, {R('sales_quantity')} AS sales_quantity,
       {R(f'coalesce(lag(sales_quantity) OVER ({WE}), 0)')} AS sales_lag_1,
       {R(f'avg(sales_quantity) OVER {_f(3)}')} AS sales_rolling_mean_3,
       {R(f'CASE WHEN count(*) OVER {_f(6)} < 2 THEN 0 ELSE coalesce(regr_slope(sales_quantity, rn) OVER {_f(6)}, 0) END')}
         AS sales_trend_6m,
       {R('share')} AS brand_platform_market_share
FROM (SELECT *, CAST(row_number() OVER ({WE}) AS DOUBLE) AS rn FROM base) b
JOIN bs USING (primary_platform, brand_name)"""))
def flagship_share_trend(spark, d):
    """Entity lags, rolling mean and 6-row trend, joined to the brand's share of its platform."""
    from ..operators.behaviour import brand_share_in_platform, join_back
    b = base(spark, d)

    def features(x, entity):
        w = tp.entity_window(entity)
        x = x.withColumn("_rn", F.row_number().over(w).cast("double"))  # the slope doesn't depend on where it starts
        return x.select("*", F.coalesce(F.lag("sales_quantity").over(w), F.lit(0.0)).alias("sales_lag_1"),
                        F.avg("sales_quantity").over(tp.frame(3, entity)).alias("sales_rolling_mean_3"),
                        F.coalesce(F.regr_slope("sales_quantity", "_rn").over(tp.frame(6, entity)), F.lit(0.0))
                        .alias("sales_trend_6m"))

    feats = skew.chunked(b, features).select(*KEYS, "sales_quantity", "sales_lag_1", "sales_rolling_mean_3", "sales_trend_6m")
    share = brand_share_in_platform(b).select("primary_platform", "brand_name", "brand_platform_market_share")
    return finalize(join_back(feats, share, ["primary_platform", "brand_name"]))

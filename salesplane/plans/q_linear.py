"""Registered queries: linear models of all splits, interval joins, committed snapshots, column reports."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import intervals as iv
from ..operators import linear
from ..operators import metrics as mt
from ..operators import quality as qa
from ..operators import skew
from ..operators import splits as sp
from ..operators import temporal as tp
from .base import D, R, base, finalize, with_base_ctes
from .catalog import register
from .q_eval import WINDOWS, _metric_sql, _windows_sql
from .q_more import FLAGS, LAG_FEATURES, SCREENED_SQL, screened_shifts

#: Known before the month: price, flags, calendar and lags (not the month's own amount).
INPUTS = ["unit_price", *FLAGS, "month", "quarter", "year", *LAG_FEATURES]
LABEL = "sales_quantity"
_N = len(INPUTS)
#: Sweeps over the coordinates in the SQL; coefficients stand still at the sixth decimal long before.
_SQL_SWEEPS = 120


def _dated(spark, d):
    m = F.col("sales_month")
    return skew.chunked(base(spark, d), lambda x, e: tp.lag_features(x, entity=e)).select(
        "sales_month", LABEL, "unit_price", *FLAGS, F.month(m).alias("month"), F.quarter(m).alias("quarter"), F.year(m).alias("year"), *LAG_FEATURES)


#: A split for every quarter after the first calendar year, trained on all that is before it (``splits.history_windows``).
_HISTORY_SQL = """win AS (SELECT CAST(row_number() OVER (ORDER BY hi) AS INTEGER) AS split_id, 'train' AS role, lo, hi
  FROM (SELECT CAST(lo AS DATE) AS lo, CAST(unnest(generate_series(lo + INTERVAL 1 YEAR, latest, INTERVAL 3 MONTH)) AS DATE) AS hi
        FROM (SELECT date_trunc('year', CAST(min(sales_month) AS TIMESTAMP)) AS lo, CAST(max(sales_month) AS TIMESTAMP) AS latest FROM base)))"""


def _linear_sql(body: str, windows: str) -> str:
    """Normal equations by Gauss-Jordan elimination and coordinate descent as recursive SQL over each split's covariances."""
    still = {f: f"var_pop({f}) <= 1e-13 * avg(CAST({f} AS DOUBLE) * {f})" for f in INPUTS}
    means = ", ".join(f"avg({f})" for f in INPUTS)
    stds = ", ".join(f"CASE WHEN {still[f]} THEN 1.0 ELSE stddev_pop({f}) END" for f in INPUTS)
    flat = ", ".join(f"CASE WHEN {still[f]} THEN 1 ELSE 0 END" for f in INPUTS)
    cov = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in INPUTS) + "]" for a in INPUTS)
    covy = ", ".join(f"covar_pop({f}, {LABEL})" for f in INPUTS)
    sql = with_base_ctes(SCREENED_SQL + f""",
{windows},
train AS (SELECT screened.*, split_id FROM screened JOIN win ON role = 'train' AND sales_month >= lo AND sales_month < hi),
mom AS (SELECT split_id, CAST(count(*) AS DOUBLE) AS n, avg({LABEL}) AS intercept, [{means}] AS mu, [{stds}] AS sd, [{flat}] AS flat,
               [{cov}] AS cov, [{covy}] AS covy FROM train GROUP BY split_id),
unit AS (SELECT split_id, n, intercept, mu, sd,
                list_transform(cov, lambda r, i: list_transform(r, lambda v, j: CASE WHEN flat[i] + flat[j] > 0 THEN 0.0 ELSE v / sd[i] / sd[j] END)) AS c,
                list_transform(covy, lambda v, i: CASE WHEN flat[i] > 0 THEN 0.0 ELSE v / sd[i] END) AS cy FROM mom),
gj(split_id, p, m) AS (
  SELECT split_id, 0, list_transform(c, lambda r, i: list_append(list_transform(r, lambda v, j: n * v + CASE WHEN i = j THEN 1.0 ELSE 0.0 END), n * cy[i])) FROM unit
  UNION ALL
  SELECT split_id, p + 1, list_transform(m, lambda r, i: CASE WHEN i = p + 1 THEN list_transform(r, lambda v: v / r[p + 1])
         ELSE list_transform(r, lambda v, j: v - r[p + 1] * m[p + 1][j] / m[p + 1][p + 1]) END) FROM gj WHERE p < {_N}),
cd(split_id, t, w) AS (
  SELECT split_id, 0, list_transform(cy, lambda v: CAST(0 AS DOUBLE)) FROM unit
  UNION ALL
  SELECT split_id, t + 1, list_transform(w, lambda v, i: CASE WHEN i <> t % {_N} + 1 THEN v ELSE
         sign(rest) * greatest(abs(rest) - 0.5, 0) / (c[t % {_N} + 1][t % {_N} + 1] + 0.5) END)
  FROM (SELECT cd.split_id, t, w, c, cy[t % {_N} + 1] - list_dot_product(c[t % {_N} + 1], w) + c[t % {_N} + 1][t % {_N} + 1] * w[t % {_N} + 1] AS rest
        FROM cd JOIN unit ON cd.split_id = unit.split_id WHERE t < {_N * _SQL_SWEEPS})),
fitted AS (SELECT split_id, 'ridge' AS model, list_transform(m, lambda r: r[{_N + 1}]) AS w FROM gj WHERE p = {_N}
           UNION ALL SELECT split_id, 'elastic_net', w FROM cd WHERE t = {_N * _SQL_SWEEPS})""", body)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_NAMES = "[" + ", ".join(f"'{f}'" for f in INPUTS) + "]"


def _fitted(spark, d, windows):
    rows = _dated(spark, d)
    return rows, linear.fit_splits(rows, windows, INPUTS, LABEL, shifts=screened_shifts(spark, d, [*INPUTS, LABEL]))


@register("m16_linear_coefficients", _linear_sql(f"""
SELECT split_id, model, feature, {R('coefficient')} AS coefficient, {R('intercept')} AS intercept, train_rows
FROM (SELECT fitted.split_id, model, unnest({_NAMES}) AS feature, unnest(w) AS coefficient, intercept, CAST(n AS BIGINT) AS train_rows
      FROM fitted JOIN unit ON fitted.split_id = unit.split_id)""", _HISTORY_SQL))
def m16_coefficients(spark, d):
    """Ridge and elastic net (penalty 1, half of it absolute) of every expanding split of the
    whole history on standardised inputs, solved from the split's sums of products."""
    _, fitted = _fitted(spark, d, sp.windows_of(base(spark, d)))
    return finalize(linear.coefficient_table(spark, fitted, INPUTS).drop("mean", "std"))


@register("m16_linear_models_validation", _linear_sql(f"""
SELECT * EXCLUDE (safe_mape_log) FROM (SELECT split_id, model, {_metric_sql()} FROM (
  SELECT win.split_id, model, {LABEL} AS y_true,
         intercept + list_sum(list_transform([{', '.join(f'CAST({f} AS DOUBLE)' for f in INPUTS)}], lambda v, i: (v - mu[i]) / sd[i] * w[i])) AS y_pred
  FROM screened JOIN win ON role = 'val' AND sales_month >= lo AND sales_month < hi
       JOIN unit ON unit.split_id = win.split_id JOIN fitted ON fitted.split_id = win.split_id)
GROUP BY split_id, model)""", _windows_sql()))
def m16_validation(spark, d):
    """Both models scored on every split's validation rows; without the metric of log-scale
    predictions, which a quantity under -1 has none of."""
    rows, fitted = _fitted(spark, d, WINDOWS)
    pred = linear.predict_splits(rows, WINDOWS, fitted, INPUTS, LABEL)
    return finalize(mt.metrics_by(pred, ["split_id", "model"]).drop("safe_mape_log"))


YEARS = range(1991, 2003)  # the tables' years and their neighbours
_EVENTS_SQL = "ev(event, anchor, days, intensity) AS (VALUES " + ", ".join(
    "('{}', DATE '{}', {}, {})".format(name.replace("'", "''"), date(y, m, dd), float(dur), float(inten))
    for y in YEARS for name, dates, dur, inten in K.PROMO_EVENTS for m, dd in dates) + ")"


@register("j5_shipments_in_promotions", f"""WITH {_EVENTS_SQL}
SELECT event, CAST(year(anchor) AS INTEGER) AS year, count(*) AS shipments, CAST(sum(l_quantity) AS BIGINT) AS quantity,
       {R('avg(intensity * greatest(0, 1 - abs(date_diff(' + "'day'" + ', anchor, CAST(l_shipdate AS DATE))) / (days / 2)))')} AS mean_intensity
FROM lineitem JOIN ev ON 2 * abs(date_diff('day', anchor, CAST(l_shipdate AS DATE))) <= days GROUP BY 1, 2""")
def j5_shipments(spark, d):
    """Shipments, quantity and mean intensity of each year's promotional events, by an interval join."""
    ev = iv.event_intervals(iv.yearly_events(spark, K.PROMO_EVENTS, YEARS))
    # One row for each day and event: days are joined, not shipments.
    days = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    near = F.greatest(F.lit(0.0), 1 - F.abs(F.datediff("day", "anchor")) / (F.col("days") / 2)) * F.col("intensity")
    hits = iv.interval_join(days, ev, "day", "first_day", "last_day").select("*", near.alias("near"))
    return finalize(hits.groupBy("event", F.year("anchor").alias("year")).agg(
        F.sum("n").alias("shipments"), F.sum("q").alias("quantity"), (F.sum(F.col("near") * F.col("n")) / F.sum("n")).alias("mean_intensity")))


@register("j5_open_orders_by_month", """WITH o AS (SELECT o_orderkey, any_value(CAST(o_orderdate AS DATE)) AS placed, max(CAST(l_shipdate AS DATE)) AS shipped
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
m AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS first_day FROM lineitem)
SELECT strftime(first_day, '%Y-%m-%d') AS first_day, count(*) AS open_orders, CAST(max(date_diff('day', placed, first_day)) AS INTEGER) AS oldest_days
FROM m JOIN o ON first_day >= placed AND first_day <= shipped GROUP BY first_day""")
def j5_open_orders(spark, d):
    """J5 with as many intervals as orders: orders placed but not wholly shipped on the first of each month."""
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.to_date("l_shipdate").alias("day"))
    last = li.groupBy("l_orderkey").agg(F.max("day").alias("shipped"))
    placed = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.to_date("o_orderdate").alias("placed"))
    spans = placed.join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("placed", "shipped")
    months = li.select(F.trunc("day", "month").alias("first_day")).distinct()
    hits = iv.interval_join(months, spans, "first_day", "placed", "shipped")
    return finalize(hits.groupBy("first_day").agg(F.count("*").alias("open_orders"), F.max(F.datediff("first_day", "placed")).alias("oldest_days")))


@register("s14_committed_snapshot", with_base_ctes("t AS (SELECT 1)", f"""
SELECT year(sales_month)::INTEGER AS year, primary_platform, count(*) AS rows, {R('sum(sales_quantity)')} AS quantity,
       count(DISTINCT store_name) AS stores FROM base GROUP BY 1, 2"""))
def s14_snapshot(spark, d):
    """The prepared fact committed as a snapshot, verified and read again."""
    from ..session import ensure_checkpoint_dir
    from ..sources import committed
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/snapshot-{uuid4().hex}"
    committed.commit(base(spark, d).drop("secondary_platform").withColumn("year", F.year("sales_month")), path, ["year"])
    back = committed.read(spark, path, verify=True)
    return finalize(back.groupBy("year", "primary_platform").agg(F.count("*").alias("rows"), F.sum("sales_quantity").alias("quantity"),
                                                                 F.count_distinct("store_name").alias("stores")))


_KINDS = {"sales_month": "date", "primary_platform": "categorical", "store_name": "categorical", "brand_name": "categorical",
          "product_code": "categorical", "sales_amount": "numeric", "sales_quantity": "numeric", "unit_price": "numeric",
          "sales_quantity_log": "numeric", "has_missing_price": "numeric", "has_zero_sales": "numeric", "has_high_price": "numeric"}


def _integrity_sql():
    def row(column, metric, value="CAST(NULL AS DOUBLE)", text="CAST(NULL AS VARCHAR)", tail=" FROM t"):
        return f"SELECT '{column}' AS column_name, '{metric}' AS metric, {value} AS value, {text} AS text{tail}"
    count = lambda cond: f"CAST(count_if({cond}) AS DOUBLE)"
    parts = [row("*", "rows", "CAST(count(*) AS DOUBLE)"), row("*", "columns", f"CAST({len(_KINDS)} AS DOUBLE)", tail=""),
             row("*", "total_missing", " + ".join(count(f"{c} IS NULL") for c in _KINDS)),
             row("*", "duplicate_rows", "CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS DOUBLE)")]
    parts += [row("*", f"{k}_columns", f"CAST({list(_KINDS.values()).count(k)} AS DOUBLE)", tail="") for k in ("numeric", "date", "categorical")]
    for c, kind in _KINDS.items():
        missing = count(f"{c} IS NULL")
        parts += [row(c, "missing", missing), row(c, "missing_percent", R(f"{missing} / count(*) * 100")), row(c, "type", text=f"'{kind}'", tail="")]
        if kind == "numeric":
            parts += [row(c, "zeros", count(f"{c} = 0")), row(c, "negatives", count(f"{c} < 0")), row(c, "infinite", count(f"isinf(CAST({c} AS DOUBLE))"))]
        elif kind == "date":
            parts += [row(c, "first_day", text=D(f"min({c})")), row(c, "last_day", text=D(f"max({c})"))]
        else:
            parts += [row(c, "unique_count", f"CAST(count(DISTINCT {c}) AS DOUBLE)"),
                      row(c, "level", "CAST(count(*) AS DOUBLE)", c, f" FROM t WHERE {c} IS NOT NULL AND (SELECT count(DISTINCT {c}) FROM t) <= 20 GROUP BY {c}")]
    return with_base_ctes(f"t AS (SELECT {', '.join(_KINDS)} FROM base)", "\nUNION ALL\n".join(parts))


@register("q1_integrity", _integrity_sql())
def q1_integrity(spark, d):
    """Q1 over all columns of the prepared fact: nulls, duplicates, kinds, zeros, negatives, infinities, ranges, levels."""
    return finalize(qa.integrity_report(base(spark, d).select(*_KINDS)))


_LEVEL_COLS = [c for c, k in _KINDS.items() if k != "numeric"]


def _levels_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count(DISTINCT v) AS unique_count, CAST(count_if(v IS NULL) AS BIGINT) AS missing,
  (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT v FROM {c}_v WHERE v IS NOT NULL ORDER BY v LIMIT 5)) AS first_values,
  CASE WHEN count(DISTINCT v) <= 20 THEN (SELECT string_agg(l, ', ' ORDER BY l) FROM (SELECT v || '=' || count(*) AS l FROM {c}_v WHERE v IS NOT NULL GROUP BY v)) END AS levels
FROM {c}_v"""


@register("x13_levels", with_base_ctes(", ".join(f"{c}_v AS (SELECT CAST({c} AS VARCHAR) AS v FROM base)" for c in _LEVEL_COLS),
                                       "\nUNION ALL\n".join(_levels_sql(c) for c in _LEVEL_COLS)))
def x13_levels(spark, d):
    """X13 whole: distinct counts, first values and the levels with their counts of every column that is no number."""
    return finalize(qa.level_report(qa.value_counts(base(spark, d), _LEVEL_COLS)))

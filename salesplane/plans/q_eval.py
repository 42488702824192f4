"""Registered queries: splits, encoders, baselines, metrics, quality, exploration, v1 blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import quantiles
from ..operators import encode as en
from ..operators import explore as xp
from ..operators import metrics as mt
from ..operators import model as md
from ..operators import platforms as pf
from ..operators import quality as qa
from ..operators import splits as sp
from ..operators import temporal as tp
from .base import D, R, base, finalize, with_base_ctes
from .catalog import register

E = "primary_platform, store_name, brand_name"
BASE_YEAR = 1999  # test data spans 1995-2001: 1999 base year gives all five splits
WINDOWS = sp.expanding_windows(BASE_YEAR)


def _windows_sql():
    rows = []
    for k, ts, te, vs, ve, desc in WINDOWS:
        rows.append(f"({k}, 'train', DATE '{ts}', DATE '{te}', '{desc}')")
        rows.append(f"({k}, 'val', DATE '{vs}', DATE '{ve}', '{desc}')")
    return f"win(split_id, role, lo, hi, description) AS (VALUES {', '.join(rows)})"


TAGGED = f"""{_windows_sql()},
tagged AS (SELECT base.*, split_id, role, description FROM base JOIN win ON sales_month >= lo AND sales_month < hi)"""


def tagged(spark, d):
    return sp.tag_splits(base(spark, d), WINDOWS)


@register("l1_split_summary", with_base_ctes(TAGGED + """,
s AS (SELECT split_id, role, count(*) AS rows, min(sales_month) AS st, max(sales_month) AS en,
             count(DISTINCT sales_month) AS months FROM tagged GROUP BY 1, 2),
ok AS (SELECT t.split_id, CAST(t.en < v.st AS INTEGER) AS ordered FROM s t JOIN s v
       ON t.split_id = v.split_id AND t.role = 'train' AND v.role = 'val')""", f"""
SELECT split_id, role, rows, {D('st')} AS start, {D('en')} AS "end", months, ordered
FROM s LEFT JOIN ok USING (split_id)"""))
def l1_split_summary(spark, d):
    return finalize(sp.split_summary(tagged(spark, d)))


PRED_SQL = f"""{TAGGED},
pm AS (SELECT split_id, primary_platform, avg(sales_quantity) AS pm FROM tagged WHERE role = 'train' GROUP BY 1, 2),
gm AS (SELECT split_id, avg(sales_quantity) AS gm FROM tagged WHERE role = 'train' GROUP BY 1),
pred AS (SELECT v.split_id, v.role, v.sales_month, v.primary_platform, v.store_name, v.brand_name, v.product_code,
                v.sales_quantity AS y_true, gm AS y_pred_mean, coalesce(pm, gm) AS y_pred
         FROM tagged v LEFT JOIN pm USING (split_id, primary_platform) LEFT JOIN gm USING (split_id)
         WHERE v.role = 'val')"""


def predictions(spark, d):
    return md.expanding_baselines(base(spark, d), WINDOWS)


def _metric_sql(y="y_true", p="y_pred"):
    clip = lambda x, lo, hi: f"least(greatest({x}, {lo}), {hi})"
    yt, yp = clip(y, 1, 1e6), clip(p, 1, 1e6)
    ly, lp = clip(f"(exp(ln(1 + {y})) - 1)", 0.1, 1e6), clip(f"(exp(ln(1 + {p})) - 1)", 0.1, 1e6)
    return ", ".join([
        f"count({y}) AS n",
        R(f"coalesce(avg(CASE WHEN abs({y}) > 1e-8 THEN abs(({y} - {p}) / {y}) END) * 100, 100.0)") + " AS mape",
        R(f"avg(abs({y} - {p}))") + " AS mae", R(f"sqrt(avg(({y} - {p}) * ({y} - {p})))") + " AS rmse",
        R(f"1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))") + " AS r2",
        R(f"avg(abs({yt} - {yp}) / ({yt} + 1)) * 100") + " AS evaluator_mape",
        R(f"avg(abs(greatest({y}, 1.0) - greatest({p}, 1.0)) / greatest({y}, 1.0)) * 100") + " AS floored_mape",
        R(f"avg(abs(({y} - {p}) / {y})) * 100") + " AS naive_mape",
        R(f"least(avg(abs({ly} - {lp}) / ({ly} + 1.0)) * 100, 1000.0)") + " AS safe_mape_log"])


def m13_metrics(spark, d):
    """M13 baselines scored by E3-E5, E7, E9, E10."""
    return finalize(mt.metrics_by(predictions(spark, d), ["split_id"]))


register("m13_baseline_metrics_by_split", with_base_ctes(PRED_SQL, f"""
SELECT split_id, {_metric_sql()} FROM pred GROUP BY split_id"""))(m13_metrics)

register("e14_metrics_by_split_platform", with_base_ctes(PRED_SQL, f"""
SELECT split_id, primary_platform, {_metric_sql()} FROM pred GROUP BY 1, 2"""))(
    lambda spark, d: finalize(mt.metrics_by(predictions(spark, d), ["split_id", "primary_platform"])))

register("e16_metrics_by_month", with_base_ctes(PRED_SQL, f"""
SELECT {D('sales_month')} AS sales_month, {_metric_sql()} FROM pred GROUP BY sales_month"""))(
    lambda spark, d: finalize(mt.metrics_by(predictions(spark, d), ["sales_month"])))


def _cat_sql(pe):
    return (f"CASE WHEN {pe} < 5 THEN 'Excellent (<5%)' WHEN {pe} < 10 THEN 'Very Good (5-10%)' "
            f"WHEN {pe} < 20 THEN 'Good (10-20%)' WHEN {pe} < 50 THEN 'Fair (20-50%)' ELSE 'Poor (>50%)' END")


@register("e1_row_errors", with_base_ctes(PRED_SQL, f"""
SELECT split_id, role, {D('sales_month')} AS sales_month, {E}, product_code, {R('y_true')} AS y_true,
       {R('y_pred_mean')} AS y_pred_mean, {R('y_pred')} AS y_pred, {R('abs(y_pred - y_true)')} AS absolute_error,
       {R('abs(y_pred - y_true) / (y_true + 1.0) * 100')} AS percentage_error,
       CAST(abs(y_pred - y_true) < 1 AS INTEGER) AS is_perfect,
       {_cat_sql('(abs(y_pred - y_true) / (y_true + 1.0) * 100)')} AS error_category FROM pred"""))
def e1_row_errors(spark, d):
    return finalize(mt.row_errors(predictions(spark, d)))


@register("e2_error_category_distribution", with_base_ctes(PRED_SQL, f"""
SELECT split_id, {_cat_sql('(abs(y_pred - y_true) / (y_true + 1.0) * 100)')} AS error_category, count(*) AS n
FROM pred GROUP BY 1, 2"""))
def e2_error_dist(spark, d):
    return finalize(mt.row_errors(predictions(spark, d)).groupBy("split_id", "error_category").agg(F.count("*").alias("n")))


@register("e11_across_splits", with_base_ctes(PRED_SQL + f""",
ps AS (SELECT split_id, {_metric_sql()} FROM pred GROUP BY 1)""", f"""
SELECT {', '.join(f"{R(f'avg({c})')} AS {c}_mean, {R(f'stddev_pop({c})')} AS {c}_std, {R(f'min({c})')} AS {c}_min, {R(f'max({c})')} AS {c}_max" for c in ('mape', 'rmse', 'r2'))},
       CASE WHEN avg(mape) <= 15 THEN 'EXCELLENT' WHEN avg(mape) <= 20 THEN 'GOOD' WHEN avg(mape) <= 30 THEN 'FAIR'
            ELSE 'POOR' END AS grade,
       CASE WHEN stddev_pop(mape) <= 3 THEN 'CONSISTENT' ELSE 'INCONSISTENT' END AS consistency_grade
FROM ps"""))
def e11_across_splits(spark, d):
    per = mt.metrics_by(predictions(spark, d), ["split_id"])
    out = mt.across_splits(per)
    return finalize(out.withColumn("grade", mt.grade(F.col("mape_mean"), "trainer"))
                    .withColumn("consistency_grade", mt.consistency_grade(F.col("mape_std"))))


@register("m1_quantile_buckets", with_base_ctes(TAGGED + f""",
ed AS (SELECT split_id, list_distinct(list_sort(quantile_cont(sales_quantity, [{', '.join(str(i / 50) for i in range(51))}]))) AS edges
        FROM tagged WHERE role = 'train' AND sales_quantity <> 0 GROUP BY 1)""", f"""
SELECT split_id, {D('sales_month')} AS sales_month, {E}, product_code,
       CAST(least(len(list_filter(edges, lambda e: e <= sales_quantity)), 51) AS INTEGER) AS quantity_bucket
FROM tagged JOIN ed USING (split_id) WHERE role = 'val'"""))
def m1_quantile_buckets(spark, d):
    t = tagged(spark, d)
    edges = en.fit_quantile_edges(t.where(F.col("role") == "train"), "sales_quantity")
    out = en.apply_buckets(t.where(F.col("role") == "val"), edges, "sales_quantity", "quantity_bucket")
    return finalize(out.select("split_id", "sales_month", *E.split(", "), "product_code",
                               F.col("quantity_bucket").cast("int")))


@register("m4_robust_scaler_fit", with_base_ctes(TAGGED, f"""
SELECT split_id, {', '.join(f"{R(f'quantile_cont({c}, 0.5)')} AS {c}__median, {R(f'CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END')} AS {c}__iqr" for c in ('sales_quantity', 'unit_price'))}
FROM tagged WHERE role = 'train' GROUP BY 1"""))
def m4_robust(spark, d):
    t = tagged(spark, d).where(F.col("role") == "train")
    return finalize(en.fit_robust(t, ["sales_quantity", "unit_price"]))


@register("m5_standard_scaler_fit", with_base_ctes(TAGGED, f"""
SELECT split_id, {', '.join(f"{R(f'avg({c})')} AS {c}__mean" for c in ('sales_quantity', 'unit_price'))},
       {', '.join(f"{R(f'CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END')} AS {c}__std" for c in ('sales_quantity', 'unit_price'))}
FROM tagged WHERE role = 'train' GROUP BY 1"""))
def m5_standard(spark, d):
    cols = ["sales_quantity", "unit_price"]
    return finalize(en.standard_of(sp.train_moments(base(spark, d), WINDOWS, cols), cols))


@register("m9_target_encoding_brand", with_base_ctes(TAGGED + """,
pr AS (SELECT split_id, avg(sales_quantity) AS prior FROM tagged WHERE role = 'train' GROUP BY 1),
g AS (SELECT split_id, brand_name, avg(sales_quantity) AS m, count(sales_quantity) AS n FROM tagged
      WHERE role = 'train' GROUP BY 1, 2)""", f"""
SELECT split_id, brand_name, {R('(1 / (1 + exp(-(n - 1.0) / 1.0))) * m + (1 - 1 / (1 + exp(-(n - 1.0) / 1.0))) * prior')} AS brand_name_te
FROM g JOIN pr USING (split_id)"""))
def m9_target_encoding(spark, d):
    b, y = base(spark, d), "sales_quantity"
    return finalize(en.target_encode_of(sp.train_moments(b, WINDOWS, [y], ["brand_name"]), sp.train_moments(b, WINDOWS, [y]),
                                        "brand_name", y))


@register("m6_minmax_apply", with_base_ctes(TAGGED + """,
mm AS (SELECT split_id, min(sales_quantity) AS a, max(sales_quantity) AS b, min(unit_price) AS c, max(unit_price) AS d
       FROM tagged WHERE role = 'train' GROUP BY 1)""", f"""
SELECT split_id, {D('sales_month')} AS sales_month, {E}, product_code,
       {R('(sales_quantity - a) / CASE WHEN b = a THEN 1 ELSE b - a END')} AS sales_quantity,
       {R('(unit_price - c) / CASE WHEN d = c THEN 1 ELSE d - c END')} AS unit_price
FROM tagged JOIN mm USING (split_id) WHERE role = 'val'"""))
def m6_minmax_apply(spark, d):
    """M6: fitted on each split's training rows, applied to its validation rows."""
    b, cols = base(spark, d), ["sales_quantity", "unit_price"]
    fitted = en.minmax_of(sp.train_moments(b, WINDOWS, cols), cols)
    rows = sp.in_windows(b, WINDOWS, "val").select("split_id", "sales_month", *E.split(", "), "product_code", *cols)
    return finalize(en.apply_minmax(rows, fitted, cols))


@register("m5_standard_apply", with_base_ctes(TAGGED + """,
ms AS (SELECT split_id, avg(sales_quantity) AS a, stddev_pop(sales_quantity) AS b, avg(unit_price) AS c, stddev_pop(unit_price) AS d
       FROM tagged WHERE role = 'train' GROUP BY 1)""", f"""
SELECT split_id, {D('sales_month')} AS sales_month, {E}, product_code,
       {R('(sales_quantity - a) / CASE WHEN b = 0 THEN 1 ELSE b END')} AS sales_quantity,
       {R('(unit_price - c) / CASE WHEN d = 0 THEN 1 ELSE d END')} AS unit_price
FROM tagged JOIN ms USING (split_id) WHERE role = 'val'"""))
def m5_standard_apply(spark, d):
    """M5: fitted on each split's training rows, applied to its validation rows."""
    b, cols = base(spark, d), ["sales_quantity", "unit_price"]
    fitted = en.standard_of(sp.train_moments(b, WINDOWS, cols), cols)
    rows = sp.in_windows(b, WINDOWS, "val").select("split_id", "sales_month", *E.split(", "), "product_code", *cols)
    return finalize(en.apply_standard(rows, fitted, cols))


HOLDOUT_YEAR = BASE_YEAR + 2


def _holdout_models(spark, d, kind):
    """Models of all splits, saved in the shared checkpoint folder, reloaded, and the hold-out report."""
    from uuid import uuid4

    from ..operators import saved_models as sm
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    b = base(spark, d)
    trained = sm.train_splits(b, WINDOWS, f"{spark.sparkContext.getCheckpointDir()}/models-{uuid4().hex}", kind)
    return sm.holdout_report(spark, trained, b.where(F.year("sales_month") == HOLDOUT_YEAR))


@register("m18_saved_ridge_holdout_year")
def m18_saved_ridge(spark, d):
    """Encoders and ridge of every split saved, reloaded and
    applied to the hold-out year; a row for each split, failed ones included."""
    return finalize(_holdout_models(spark, d, "ridge"))


@register("m16_saved_elastic_net_holdout_year")
def m16_saved_elastic_net(spark, d):
    """M16 / M17 / M18 with the elastic net."""
    return finalize(_holdout_models(spark, d, "elastic_net"))


@register("m14_random_forest_holdout")
def m14_random_forest(spark, d):
    """Per split, a random forest on calendar parts and price (log target),
    scored on the split's validation rows; rows-only check (no SQL form)."""
    m = F.col("sales_month")
    rows = base(spark, d).select(m, F.month(m).alias("month"), F.quarter(m).alias("quarter"), F.year(m).alias("year"),
                                 "unit_price", "sales_quantity_log")
    return holdout_metrics(rows, ["month", "quarter", "year", "unit_price"], "rf", numTrees=50, maxDepth=5)


def holdout_metrics(rows, feats, kind, **params):
    """Metrics of each split's regressor on its validation rows.  ``rows`` has only what the
    regressors read, so the many passes of their fits read a narrow table."""
    rows = rows.where((F.col("sales_month") >= F.lit(min(w[1] for w in WINDOWS)))
                      & (F.col("sales_month") < F.lit(max(w[4] for w in WINDOWS)))).persist()
    outs = []
    for _, tr, va in sp.split_frames(rows, WINDOWS):
        model = md.fit_regressor(tr, feats, kind, **params)
        outs.append(md.predict_original_scale(model, va).select("split_id", "y_true", "y_pred"))
    allp = outs[0]
    for o in outs[1:]:
        allp = allp.unionByName(o)
    return finalize(mt.metrics_by(allp, ["split_id"]))


# ------------------------------------------------------------ quality / X ----

@register("q1_numeric_profile", with_base_ctes("t AS (SELECT 1)", f"""
SELECT column_name, metric, {R('value')} AS value FROM (
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, m.metric, m.value FROM (SELECT unnest([{{'metric': 'nulls', 'value': CAST(count_if({c} IS NULL) AS DOUBLE)}}, {{'metric': 'zeros', 'value': CAST(count_if({c} = 0) AS DOUBLE)}}, {{'metric': 'negatives', 'value': CAST(count_if({c} < 0) AS DOUBLE)}}, {{'metric': 'infinite', 'value': CAST(count_if(abs({c}) = 'Infinity'::DOUBLE) AS DOUBLE)}}, {{'metric': 'min', 'value': CAST(min({c}) AS DOUBLE)}}, {{'metric': 'max', 'value': CAST(max({c}) AS DOUBLE)}}, {{'metric': 'mean', 'value': avg({c})}}, {{'metric': 'std', 'value': stddev_samp({c})}}]) AS m FROM base) x(m)" for c in ('sales_amount', 'sales_quantity', 'unit_price'))})"""))
def q1_numeric_profile(spark, d):
    b = base(spark, d)
    return finalize(qa.numeric_profile(b, ["sales_amount", "sales_quantity", "unit_price"]))


@register("u3_duplicate_rows", with_base_ctes("t AS (SELECT 1)", """
SELECT CAST(sum(c) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS c FROM base GROUP BY sales_month, primary_platform, store_name, brand_name, product_code,
      sales_amount, sales_quantity, unit_price, sales_quantity_log, has_missing_price, has_zero_sales, has_high_price)"""))
def u3_duplicates(spark, d):
    return finalize(qa.duplicate_rows(base(spark, d).drop("secondary_platform")))


@register("x1_platform_year_coverage", with_base_ctes("t AS (SELECT 1)", f"""
SELECT primary_platform, CAST(year(sales_month) AS INTEGER) AS year, {D('min(sales_month)')} AS first_month,
       {D('max(sales_month)')} AS last_month, count(DISTINCT sales_month) AS months, count(sales_quantity) AS rows,
       {R('sum(sales_quantity)')} AS quantity, count(DISTINCT store_name) AS stores, count(DISTINCT brand_name) AS brands
FROM base GROUP BY 1, 2"""))
def x1_coverage(spark, d):
    return finalize(xp.platform_year_coverage(base(spark, d)))


@register("x4_monthly_totals", with_base_ctes("t AS (SELECT 1)", f"""
SELECT CAST(year(sales_month) AS INTEGER) AS year, CAST(month(sales_month) AS INTEGER) AS month,
       {R('sum(sales_quantity)')} AS quantity,
       {R('CAST(SUM(CAST(ROUND(sales_amount * 100) AS BIGINT)) AS DOUBLE) / 100')} AS amount,
       {R('avg(sales_quantity)')} AS mean_quantity FROM base GROUP BY 1, 2"""))
def x4_monthly(spark, d):
    return finalize(xp.monthly_totals(base(spark, d)))


@register("x5_platform_stats", with_base_ctes("t AS (SELECT 1)", f"""
SELECT primary_platform, count(sales_quantity) AS count, {R('sum(sales_quantity)')} AS sum,
       {R('avg(sales_quantity)')} AS mean, {R('stddev_samp(sales_quantity)')} AS std,
       {R('min(sales_quantity)')} AS min, {R('max(sales_quantity)')} AS max FROM base GROUP BY 1"""))
def x5_platform_stats(spark, d):
    return finalize(xp.platform_stats(base(spark, d)))


PLATS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("x6_month_platform_pivot", with_base_ctes("t AS (SELECT 1)", f"""
SELECT {D('sales_month')} AS sales_month,
       {', '.join(f"{R(f'coalesce(sum(CASE WHEN primary_platform = {chr(39)}{p}{chr(39)} THEN sales_quantity END), 0)')} AS {p}" for p in PLATS)}
FROM base GROUP BY sales_month"""))
def x6_pivot(spark, d):
    return finalize(xp.month_platform_pivot(base(spark, d), PLATS))


@register("x8_quantity_percentiles", with_base_ctes("t AS (SELECT 1)", f"""
SELECT {R('quantile_cont(sales_quantity, 0.9)')} AS p90, {R('quantile_cont(sales_quantity, 0.95)')} AS p95,
       {R('quantile_cont(sales_quantity, 0.99)')} AS p99, {R('max(sales_quantity)')} AS max FROM base"""))
def x8_percentiles(spark, d):
    return finalize(xp.quantity_percentiles(base(spark, d)))


@register("x9_top5_rows", with_base_ctes("t AS (SELECT 1)", f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code, {R('sales_quantity')} AS sales_quantity FROM base
ORDER BY sales_quantity DESC, sales_month, primary_platform, store_name, brand_name, product_code LIMIT 5"""))
def x9_top(spark, d):
    return finalize(xp.top_rows(base(spark, d)).select("sales_month", *E.split(", "), "product_code", "sales_quantity"))


# ------------------------------------------------------------ v1 blocks ------

@register("a37_monthly_platform_competition", with_base_ctes("t AS (SELECT 1)", f"""
SELECT {D('sales_month')} AS sales_month, primary_platform, count(DISTINCT brand_name) AS monthly_brand_count,
       count(DISTINCT store_name) AS monthly_store_count, {R('sum(sales_quantity)')} AS monthly_platform_sales,
       {R('avg(sales_quantity)')} AS monthly_platform_avg, count(sales_quantity) AS monthly_platform_records
FROM base GROUP BY 1, 2"""))
def a37(spark, d):
    return finalize(pf.monthly_platform_competition(base(spark, d)))


@register("a38_brand_platform_preference", with_base_ctes("""
b AS (SELECT brand_name, count(DISTINCT primary_platform) AS np, avg(sales_quantity) AS ball FROM base GROUP BY 1),
bp AS (SELECT brand_name, primary_platform, avg(sales_quantity) AS bpm FROM base GROUP BY 1, 2)""", f"""
SELECT brand_name, primary_platform, CAST(np > 1 AS INTEGER) AS is_multi_platform_brand,
       {R('CASE WHEN np > 1 THEN bpm / ball ELSE 1.0 END')} AS platform_preference_score FROM bp JOIN b USING (brand_name)"""))
def a38(spark, d):
    return finalize(pf.brand_platform_preference(base(spark, d)))


@register("a39_learned_monthly_intensity", with_base_ctes("g AS (SELECT avg(sales_quantity) AS g FROM base)", f"""
SELECT CAST(month(sales_month) AS INTEGER) AS month, {R('avg(sales_quantity) / any_value(g)')} AS monthly_intensity_learned
FROM base, g GROUP BY 1"""))
def a39(spark, d):
    return finalize(pf.learned_monthly_intensity(base(spark, d)))


@register("a40_brand_seasonal_index", with_base_ctes("""
t AS (SELECT brand_name, CAST(month(sales_month) AS INTEGER) AS month, sum(sales_quantity) AS s, count(*) AS n
      FROM base GROUP BY 1, 2)""", f"""
SELECT brand_name, month, {R('(s / n) / (sum(s) OVER (PARTITION BY brand_name) / sum(n) OVER (PARTITION BY brand_name))')}
       AS brand_seasonal_index FROM t"""))
def a40(spark, d):
    return finalize(pf.brand_seasonal_index(base(spark, d)))


@register("a41_brand_promo_effectiveness", with_base_ctes("t AS (SELECT 1)", f"""
SELECT brand_name, {R('coalesce(avg(CASE WHEN month(sales_month) IN (1, 6, 9, 11, 12) THEN sales_quantity END) / NULLIF(avg(CASE WHEN month(sales_month) NOT IN (1, 6, 9, 11, 12) THEN sales_quantity END), 0), 1.0)')}
       AS brand_promo_effectiveness FROM base GROUP BY 1"""))
def a41(spark, d):
    b = base(spark, d).withColumn("is_promo_month", F.month("sales_month").isin(1, 6, 9, 11, 12).cast("int"))
    return finalize(pf.brand_promo_effectiveness(b))


@register("a42_yoy_growth_potential", with_base_ctes("t AS (SELECT 1)", f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code,
       {R(f'CASE WHEN year(sales_month) = 2000 AND month(sales_month) BETWEEN 4 AND 12 THEN sales_quantity / avg(sales_quantity) OVER (PARTITION BY {E}, month(sales_month)) ELSE 1.0 END')}
       AS yoy_growth_potential FROM base"""))
def a42(spark, d):
    out = pf.yoy_growth_potential(base(spark, d), 2000)
    return finalize(out.select("sales_month", *E.split(", "), "product_code", "yoy_growth_potential"))


@register("a43_spike_history", with_base_ctes(
    "qq AS (SELECT quantile_cont(sales_quantity, 0.95) AS q95, quantile_cont(sales_quantity, 0.99) AS q99 FROM base)", f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code, is_extreme_spike, is_major_spike,
       CAST(sum(is_extreme_spike) OVER (PARTITION BY {E}) AS BIGINT) AS historical_extreme_spikes,
       CAST(sum(is_major_spike) OVER (PARTITION BY {E}) AS BIGINT) AS historical_major_spikes,
       {R(f'sum(is_major_spike) OVER (PARTITION BY {E}) / row_number() OVER (PARTITION BY {E} ORDER BY sales_month, product_code)')}
       AS spike_propensity
FROM (SELECT base.*, CAST(sales_quantity > q99 AS INTEGER) AS is_extreme_spike,
             CAST(sales_quantity > q95 AS INTEGER) AS is_major_spike FROM base, qq)"""))
def a43(spark, d):
    """A43 / W24."""
    b = base(spark, d)
    q95, q99 = quantiles(b, "sales_quantity", [0.95, 0.99])
    out = tp.spike_history(b, q95, q99)
    return finalize(out.select("sales_month", *E.split(", "), "product_code", "is_extreme_spike", "is_major_spike",
                               "historical_extreme_spikes", "historical_major_spikes", "spike_propensity"))


@register("a45_top_brand_flag", with_base_ctes("""
top AS (SELECT brand_name FROM base GROUP BY 1 ORDER BY count(*) DESC, brand_name LIMIT 5)""", """
SELECT brand_name, CAST(brand_name IN (SELECT brand_name FROM top) AS INTEGER) AS is_top_brand FROM base GROUP BY 1"""))
def a45(spark, d):
    return finalize(pf.top_brand_flag(base(spark, d)))

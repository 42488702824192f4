"""Registered queries: grading, readiness, monitoring and recommendation rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as cl
from ..operators import metrics as mt
from ..operators import temporal as tp
from .base import D, R, base, finalize, with_base, with_base_ctes
from .catalog import register
from .q_eval import PRED_SQL, _metric_sql, predictions

PER_SPLIT = PRED_SQL + f""",
ps AS (SELECT split_id, {_metric_sql()} FROM pred GROUP BY 1),
su AS (SELECT avg(mape) AS m, stddev_pop(mape) AS s FROM ps)"""
# The tables hold no training runs; a run log is derived from the predictions:
# epochs from the split's rows, best epoch from its distinct months and brands.
RUNS = PER_SPLIT + """,
runs AS (SELECT split_id, 20 + count(*) % 120 AS epochs_trained,
                1 + (count(*) + 7 * count(DISTINCT sales_month) + count(DISTINCT brand_name)) % 20 AS best_epoch
         FROM pred GROUP BY 1),
eff AS (SELECT avg(epochs_trained) AS e, avg(best_epoch) AS b, avg(CAST(epochs_trained < 100 AS DOUBLE)) AS r,
               stddev_pop(best_epoch) / avg(best_epoch) AS t FROM runs)"""
REFERENCE_MAPE = 60.0


def per_split(spark, d):
    return mt.metrics_by(predictions(spark, d), ["split_id"])


def summary(spark, d):
    return mt.across_splits(per_split(spark, d), ("mape",)).select("mape_mean", "mape_std")


def runs(spark, d):
    n = F.count("*")
    return predictions(spark, d).groupBy("split_id").agg(
        (20 + n % 120).alias("epochs_trained"),
        (1 + (n + 7 * F.count_distinct("sales_month") + F.count_distinct("brand_name")) % 20).alias("best_epoch"))


@register("e8_monitored_metrics", with_base_ctes(PRED_SQL, f"""
SELECT split_id, {R("least(greatest(avg(abs(yt - yp) / (yt + 1.0)) * 100, 0), 1000)")} AS monitored_mape,
       {R("sqrt(avg((yt - yp) * (yt - yp)))")} AS monitored_rmse
FROM (SELECT split_id, least(greatest(exp(ln(1 + y_true)) - 1, 1.0), 1e6) AS yt,
             least(greatest(exp(ln(1 + y_pred)) - 1, 1.0), 1e6) AS yp FROM pred) GROUP BY split_id"""))
def e8_monitored(spark, d):
    return finalize(predictions(spark, d).groupBy("split_id").agg(
        *mt.monitored_metrics(F.log1p("y_true"), F.log1p("y_pred"))))


@register("e12_grades", with_base_ctes(PER_SPLIT, """
SELECT split_id,
  CASE WHEN mape <= 15 THEN 'EXCELLENT' WHEN mape <= 20 THEN 'GOOD' WHEN mape <= 30 THEN 'FAIR' ELSE 'POOR' END AS trainer,
  CASE WHEN mape <= 10 THEN 'EXCELLENT' WHEN mape <= 20 THEN 'GOOD' WHEN mape <= 30 THEN 'FAIR' ELSE 'POOR' END AS phase3,
  CASE WHEN mape < 15 THEN 'EXCELLENT' WHEN mape < 25 THEN 'GOOD' WHEN mape < 40 THEN 'MODERATE' ELSE 'POOR' END AS fixed,
  CASE WHEN mape <= 5 THEN 'EXCELLENT' WHEN mape <= 10 THEN 'USABLE' WHEN mape <= 20 THEN 'BARELY USABLE' ELSE 'POOR' END AS notebook
FROM ps"""))
def e12_grades(spark, d):
    return finalize(per_split(spark, d).select("split_id", *[mt.grade(F.col("mape"), r).alias(r) for r in mt.GRADE_RULES]))


@register("e13_business_ready", with_base_ctes(PER_SPLIT, f"""
SELECT {R('m')} AS mape_mean, {R('s')} AS mape_std, CAST(m <= 50 AS INTEGER) AS meets_expected, CAST(s <= 5 AS INTEGER) AS consistent,
       CAST(m <= 20 AND s <= 5 AS INTEGER) AS business_ready,
       CASE WHEN m - {REFERENCE_MAPE} > 5 THEN 'worse' WHEN m - {REFERENCE_MAPE} < -2 THEN 'better' ELSE 'comparable' END AS against_reference,
       CAST(m <= 50 AND s <= 5 AND m - {REFERENCE_MAPE} <= 5 AS INTEGER) AS validation_passed FROM su"""))
def e13_business(spark, d):
    return finalize(mt.business_ready(summary(spark, d), 50, REFERENCE_MAPE))


@register("e20_training_efficiency", with_base_ctes(RUNS, f"""
SELECT {R('e')} AS average_epochs_used, {R('b')} AS average_best_epoch, {R('r')} AS early_stopping_rate,
       {R('t')} AS training_stability FROM eff"""))
def e20_efficiency(spark, d):
    return finalize(mt.training_efficiency(runs(spark, d)))


@register("e21_recommendations", with_base_ctes(RUNS + f""",
pp AS (SELECT max(mape) - min(mape) AS spread FROM (SELECT primary_platform, {_metric_sql()} FROM pred GROUP BY 1))""", """
SELECT array_to_string(list_filter([
         CASE WHEN m <= 15 THEN 'ready_for_production' WHEN m <= 20 THEN 'suitable_for_business_use' ELSE 'needs_improvement' END,
         CASE WHEN s > 3 THEN 'check_overfitting' END,
         CASE WHEN r > 0.8 THEN 'fewer_epochs' WHEN r < 0.2 THEN 'more_epochs' END,
         CASE WHEN spread > 10 THEN 'tune_by_platform' END], lambda x: x IS NOT NULL), ',') AS recommendations FROM su, eff, pp"""))
def e21_recommendations(spark, d):
    by_platform = mt.metrics_by(predictions(spark, d), ["primary_platform"]).agg(
        (F.max("mape") - F.min("mape")).alias("platform_spread"))
    eff = mt.training_efficiency(runs(spark, d)).select("early_stopping_rate")
    # three one-row tables
    out = mt.recommendations(summary(spark, d).crossJoin(eff).crossJoin(by_platform))
    return finalize(out.select(F.array_join("recommendations", ",").alias("recommendations")))


@register("e24_degradation", with_base_ctes(PER_SPLIT, f"""
SELECT split_id, {R('mape')} AS mape, CASE WHEN mape - 60.0 > 2 THEN 'alert' WHEN mape - 60.0 > 1 THEN 'warning' ELSE 'stable' END AS status FROM ps"""))
def e24_degradation(spark, d):
    return finalize(per_split(spark, d).select("split_id", "mape", mt.degradation(F.col("mape"), REFERENCE_MAPE).alias("status")))


@register("e25_health", with_base_ctes(PER_SPLIT, f"""
SELECT {R('m')} AS mape_mean, {R('s')} AS mape_std,
       CASE WHEN m > 50 THEN 'very_high' WHEN m > 30 THEN 'high' WHEN m < 10 THEN 'suspiciously_low' ELSE 'reasonable' END AS mape_health,
       CASE WHEN s > 5 THEN 'high_variance' ELSE 'consistent' END AS std_health FROM su"""))
def e25_health(spark, d):
    out = summary(spark, d)
    return finalize(out.select("mape_mean", "mape_std", *mt.health_rules(F.col("mape_mean"), F.col("mape_std"))))


@register("e17_sanity_flags", with_base_ctes(PER_SPLIT + """,
pf AS (SELECT avg(CAST(abs(y_pred - y_true) < 1 AS DOUBLE)) AS share FROM pred)""", f"""
SELECT {R('m')} AS mape_mean, {R('s')} AS mape_std, {R('share')} AS perfect_share, CAST(m < 5 AS INTEGER) AS suspiciously_low_mape,
       CAST(s < 2 AND m < 15 AS INTEGER) AS suspiciously_stable, CAST(share > 0.1 AS INTEGER) AS too_many_perfect FROM su, pf"""))
def e17_sanity(spark, d):
    perfect = mt.row_errors(predictions(spark, d)).agg(F.avg(F.col("is_perfect").cast("double")).alias("perfect_share"))
    return finalize(mt.sanity_flags(summary(spark, d).crossJoin(perfect)))  # two one-row tables


@register("e19_compare_baselines", with_base_ctes(PRED_SQL + f""",
a AS (SELECT split_id, {_metric_sql(p="y_pred_mean")} FROM pred GROUP BY 1), b AS (SELECT split_id, {_metric_sql()} FROM pred GROUP BY 1)""", f"""
SELECT split_id, {R('a.mape')} AS mape_mean, {R('b.mape')} AS mape_platform, {R('a.mape - b.mape')} AS improvement_points,
       CASE WHEN a.mape > b.mape THEN 'platform' WHEN a.mape < b.mape THEN 'mean' ELSE 'tie' END AS winner FROM a JOIN b USING (split_id)"""))
def e19_compare(spark, d):
    p = predictions(spark, d)
    a, b = (mt.metrics_by(p, ["split_id"], p=c).withColumn("mape", F.floor(F.col("mape") * 1e6 + 0.5) / 1e6) for c in ("y_pred_mean", "y_pred"))
    return finalize(mt.compare_models(a, b, "mean", "platform"))


E = "primary_platform, store_name, brand_name"


PLATFORMS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("n7_one_hot", with_base(f"""
SELECT product_code, count(*) AS rows, {', '.join(f"CAST(count_if(primary_platform = '{p}') AS BIGINT) AS platform_{p}" for p in PLATFORMS)},
       CAST(count(*) AS BIGINT) AS decoded FROM base GROUP BY 1"""))
def n7_one_hot(spark, d):
    """N7 encoding and N6 decoding back to the label."""
    cols = [f"platform_{p}" for p in PLATFORMS]
    x = cl.one_hot_to_label(cl.one_hot(base(spark, d), "primary_platform", PLATFORMS, "platform"), cols, "label", "platform_")
    return finalize(x.groupBy("product_code").agg(
        F.count("*").alias("rows"), *[F.sum(F.col(c).cast("long")).alias(c) for c in cols],
        F.count_if(F.col("label") == F.col("primary_platform")).alias("decoded")))


@register("w30_forward_fill", with_base(f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code, {R('last_value(u IGNORE NULLS) OVER w')} AS unit_price
FROM (SELECT *, CASE WHEN CAST(product_code AS BIGINT) % 3 <> 0 THEN unit_price END AS u FROM base)
WINDOW w AS (PARTITION BY {E} ORDER BY sales_month, product_code ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def w30_ffill(spark, d):
    """W30 over unit prices of which every third product's are missing."""
    b = base(spark, d).withColumn("unit_price", F.when(F.col("product_code").cast("long") % 3 != 0, F.col("unit_price")))
    return finalize(tp.forward_fill(b, ["unit_price"]).select("sales_month", *tp.ENTITY, "product_code", "unit_price"))

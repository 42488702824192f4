"""Registered queries: remaining calendar variants, v1 blocks, reports, rules and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import group_quantiles
from ..operators import calendar as cal
from ..operators import encode as en
from ..operators import gram
from ..operators import interactions as ix
from ..operators import metrics as mt
from ..operators import model as md
from ..operators import quality as qa
from ..operators import skew
from ..operators import splits as sp
from ..operators import stores as st
from ..operators import temporal as tp
from .base import D, R, base, finalize, with_base_ctes
from .catalog import register
from .q_eval import PRED_SQL, TAGGED, WINDOWS, _metric_sql, holdout_metrics, predictions, tagged

E = "primary_platform, store_name, brand_name"
KEYS = ["sales_month", *tp.ENTITY, "product_code"]
KEYS_SQL = f"{D('sales_month')} AS sales_month, {E}, product_code"
PLATS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NOP = "t AS (SELECT 1)"


@register("t2_days_since_start", with_base_ctes("d0 AS (SELECT min(sales_month) AS d0 FROM base)", f"""
SELECT {KEYS_SQL}, CAST(sales_month - d0 AS INTEGER) AS days_since_start FROM base, d0"""))
def t2_days_since_start(spark, d):
    return finalize(tp.days_since_start(base(spark, d)).select(*KEYS, "days_since_start"))


@register("t5_cyclical_v1_year_flag", with_base_ctes(NOP, f"""
SELECT {KEYS_SQL}, {R('sin(2 * pi() * month(sales_month) / 12)')} AS month_sin_v1,
       {R('cos(2 * pi() * month(sales_month) / 12)')} AS month_cos_v1,
       {R('sin(2 * pi() * quarter(sales_month) / 4)')} AS quarter_sin_v1,
       {R('cos(2 * pi() * quarter(sales_month) / 4)')} AS quarter_cos_v1,
       CAST(year(sales_month) = 2000 AS INTEGER) AS is_2000 FROM base"""))
def t5_cyclical(spark, d):
    out = tp.year_flag(tp.cyclical_v1(base(spark, d)), 2000)
    return finalize(out.select(*KEYS, "month_sin_v1", "month_cos_v1", "quarter_sin_v1", "quarter_cos_v1", "is_2000"))


@register("t12_month_from_text", with_base_ctes(NOP, """
SELECT DISTINCT strftime(sales_month, '%Y-%m') AS month_text,
       CAST(regexp_extract(strftime(sales_month, '%Y-%m'), '-(\\d+)', 1) AS INTEGER) AS month_num,
       CAST(regexp_extract(strftime(sales_month, '%Y-%m'), '(\\d+)', 1) AS INTEGER) AS month_num_defect FROM base"""))
def t12_month_text(spark, d):
    t = base(spark, d).select(F.date_format("sales_month", "yyyy-MM").alias("month_text")).distinct()
    return finalize(t.select("month_text", tp.month_from_text("month_text").alias("month_num"),
                             tp.month_from_text("month_text", defect=True).alias("month_num_defect")))


def _promo_flag_sql():
    from .q_core import _calendar_sql
    return _calendar_sql("SELECT DISTINCT sales_month AS d FROM base").replace(
        f"SELECT {D('d')} AS d, is_promotional_period,", "SELECT d, is_promotional_period,", 1)


@register("i2_promo_platform_interactions", with_base_ctes(f"cal AS (WITH {_promo_flag_sql()})", f"""
SELECT {KEYS_SQL}, {', '.join(f"is_promotional_period * CAST(primary_platform = '{p}' AS INTEGER) AS promo_{p.lower()}_interaction" for p in PLATS)}
FROM base JOIN cal ON base.sales_month = cal.d"""))
def i2_promo_interactions(spark, d):
    b = cal.add_calendar(base(spark, d), columns=["is_promotional_period"])
    out = ix.platform_interactions(b, PLATS)
    return finalize(out.select(*KEYS, *[f"promo_{p.lower()}_interaction" for p in PLATS]))


STORE_ORDER = ["sales_month", "primary_platform", "brand_name", "product_code"]


def _w27_sql():
    case = " ".join(f"WHEN {' OR '.join(f'contains(store_name, {chr(39)}{x}{chr(39)})' for x in subs)} THEN '{lab}'"
                    for subs, lab in st.K.STORE_TYPE_RULES_V1)
    return with_base_ctes(f"""typed AS (SELECT *, CASE WHEN store_name IS NULL THEN '{st.K.STORE_TYPE_V1_NULL}' {case}
                                 ELSE '{st.K.STORE_TYPE_V1_OTHER}' END AS store_type_v1 FROM base)""", f"""
SELECT {KEYS_SQL}, {R('CASE WHEN isfinite(pc) THEN pc ELSE 0 END')} AS store_pct_change
FROM (SELECT *, CASE WHEN lag(sales_quantity) OVER w IS NULL THEN NULL
                     WHEN lag(sales_quantity) OVER w = 0 THEN (CASE WHEN sales_quantity > 0 THEN 'Infinity'::DOUBLE
                          WHEN sales_quantity < 0 THEN '-Infinity'::DOUBLE END)
                     ELSE (sales_quantity - lag(sales_quantity) OVER w) / lag(sales_quantity) OVER w END AS pc
      FROM typed WINDOW w AS (PARTITION BY store_type_v1, brand_name ORDER BY {', '.join(W27_ORDER)}))""", True)


W27_ORDER = ["sales_month", "primary_platform", "store_name", "product_code"]


@register("w27_store_pct_change", _w27_sql())
def w27_store_pct(spark, d):
    """The store is identified by store type and brand."""
    b = base(spark, d, True)
    b = b.join(st.store_type_v1(b).select("store_name", "store_type_v1"), "store_name")
    out = tp.group_pct_change(b, "sales_quantity", ["store_type_v1", "brand_name"], "store_pct_change", W27_ORDER)
    return finalize(out.select(*KEYS, "store_pct_change"))


def _a14_sql():
    from .q_dims import _n1_sql
    sql = _n1_sql()
    head = sql[:sql.rindex("\nSELECT store_name, store_type,")]
    return head + """
SELECT store_name, CAST(store_type IN ('flagship', 'official', 'supermarket') AS INTEGER) AS store_trust_verified FROM ty"""


@register("a14_trust_verified", _a14_sql())
def a14_trust(spark, d):
    return finalize(st.trust_verified(st.store_types(base(spark, d, True))))


def _a44_sql():
    case = " ".join(f"WHEN {' OR '.join(f'contains(store_name, {chr(39)}{x}{chr(39)})' for x in subs)} THEN '{lab}'"
                    for subs, lab in st.K.STORE_TYPE_RULES_V1)
    return with_base_ctes("g AS (SELECT avg(sales_quantity) AS gq, avg(unit_price) AS gp FROM base)", f"""
SELECT CASE WHEN store_name IS NULL THEN '{st.K.STORE_TYPE_V1_NULL}' {case} ELSE '{st.K.STORE_TYPE_V1_OTHER}' END
         AS store_type_v1,
       {R('avg(sales_quantity) / any_value(gq)')} AS store_type_sales_index,
       {R('avg(unit_price) / any_value(gp)')} AS store_type_price_index FROM base, g GROUP BY 1""", True)


@register("a44_store_type_index", _a44_sql())
def a44_store_type_index(spark, d):
    b = base(spark, d, True)
    b = b.join(st.store_type_v1(b).select("store_name", "store_type_v1"), "store_name")
    return finalize(st.store_type_index(b))


@register("x2_missing_by_platform", with_base_ctes(NOP, """
SELECT primary_platform, CAST(count_if(store_name IS NULL) AS BIGINT) AS missing_store_name,
       CAST(count_if(brand_name IS NULL) AS BIGINT) AS missing_brand_name,
       CAST(count_if(product_code IS NULL) AS BIGINT) AS missing_product_code
FROM base GROUP BY 1"""))
def x2_missing(spark, d):
    from ..operators import explore as xp
    return finalize(xp.missing_by_platform(base(spark, d)))


@register("x13_unique_counts", with_base_ctes(NOP, """
SELECT * FROM (VALUES ('primary_platform', (SELECT count(DISTINCT primary_platform) FROM base)),
                      ('store_name', (SELECT count(DISTINCT store_name) FROM base)),
                      ('brand_name', (SELECT count(DISTINCT brand_name) FROM base)),
                      ('product_code', (SELECT count(DISTINCT product_code) FROM base)),
                      ('sales_month', (SELECT count(DISTINCT sales_month) FROM base))) v(column_name, unique_count)"""))
def x13_unique(spark, d):
    cols = ["primary_platform", "store_name", "brand_name", "product_code", "sales_month"]
    wide = base(spark, d).agg(*[F.count_distinct(c).alias(c) for c in cols])
    return finalize(wide.unpivot([], cols, "column_name", "unique_count"))


@register("q2_dataset_checks", with_base_ctes(NOP, f"""
SELECT count(*) AS rows, count(DISTINCT primary_platform) AS platforms, count(DISTINCT sales_month) AS months,
       {D('min(sales_month)')} AS date_min, {D('max(sales_month)')} AS date_max, {R('avg(sales_quantity)')} AS mean_quantity,
       CAST(sum(CAST(ROUND(sales_amount * 100) AS BIGINT)) AS BIGINT) AS total_amount_cents,
       CAST(count_if(sales_quantity < 0) AS BIGINT) AS negative_rows,
       CAST(count_if(sales_quantity = 0) AS BIGINT) AS zero_rows, CAST(count_if(sales_quantity < 0) > 0 AS INTEGER) AS issue_negative,
       CAST(count_if(sales_quantity = 0) > 0.1 * count(*) AS INTEGER) AS issue_many_zeros FROM base"""))
def q2_checks(spark, d):
    return finalize(qa.dataset_checks(base(spark, d)))


@register("q4_iqr_outliers", with_base_ctes("""
qq AS (SELECT quantile_cont(sales_quantity, 0.25) AS q1, quantile_cont(sales_quantity, 0.75) AS q3,
              quantile_cont(unit_price, 0.25) AS p1, quantile_cont(unit_price, 0.75) AS p3 FROM base)""", f"""
SELECT 'sales_quantity' AS column_name, {R('any_value(q1)')} AS q25, {R('any_value(q3)')} AS q75,
       CAST(count_if(sales_quantity < q1 - 1.5 * (q3 - q1) OR sales_quantity > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
FROM base, qq
UNION ALL
SELECT 'unit_price', {R('any_value(p1)')}, {R('any_value(p3)')},
       CAST(count_if(unit_price < p1 - 1.5 * (p3 - p1) OR unit_price > p3 + 1.5 * (p3 - p1)) AS BIGINT) FROM base, qq"""))
def q4_iqr(spark, d):
    b = base(spark, d)
    rows = []
    for c in ("sales_quantity", "unit_price"):
        q1, q3 = __import__("salesplane.functions.stats", fromlist=["quantiles"]).quantiles(b, c, [0.25, 0.75])
        iqr = q3 - q1
        n = b.where((F.col(c) < q1 - 1.5 * iqr) | (F.col(c) > q3 + 1.5 * iqr)).count()
        rows.append((c, q1, q3, n))
    spark_df = spark.createDataFrame(rows, "column_name string, q25 double, q75 double, outliers long")
    return finalize(spark_df)


@register("e18_prediction_distribution", with_base_ctes(PRED_SQL, f"""
SELECT split_id, CAST(count_if(y_pred < 1) AS BIGINT) AS near_zero, CAST(count_if(y_pred > 100000) AS BIGINT) AS extreme,
       CAST(count_if(y_pred < 0) AS BIGINT) AS negative,
       {R('min(y_pred)')} AS pred_min, {R('max(y_pred)')} AS pred_max FROM pred GROUP BY 1"""))
def e18_dist(spark, d):
    p = predictions(spark, d)
    x = F.col("y_pred")
    return finalize(p.groupBy("split_id").agg(F.count_if(x < 1).alias("near_zero"), F.count_if(x > 100000).alias("extreme"),
                                              F.count_if(x < 0).alias("negative"), F.min(x).alias("pred_min"),
                                              F.max(x).alias("pred_max")))


@register("e23_baseline_comparison", with_base_ctes(PRED_SQL + f""",
b AS (SELECT split_id,
             avg(abs(least(greatest(y_true, 1), 1e6) - least(greatest(y_pred_mean, 1), 1e6)) / (least(greatest(y_true, 1), 1e6) + 1)) * 100 AS mean_mape,
             avg(abs(least(greatest(y_true, 1), 1e6) - least(greatest(y_pred, 1), 1e6)) / (least(greatest(y_true, 1), 1e6) + 1)) * 100 AS platform_mape
      FROM pred GROUP BY 1)""", f"""
SELECT split_id, {R('mean_mape')} AS mean_baseline_mape, {R('platform_mape')} AS platform_baseline_mape,
       CASE WHEN platform_mape < mean_mape THEN 'platform_baseline' ELSE 'mean_baseline' END AS best_baseline,
       {R('least(mean_mape, platform_mape)')} AS best_baseline_mape FROM b"""))
def e23_baselines(spark, d):
    p = predictions(spark, d)
    t = p.groupBy("split_id").agg(mt.evaluator_mape(F.col("y_true"), F.col("y_pred_mean")).alias("mean_baseline_mape"),
                                  mt.evaluator_mape(F.col("y_true"), F.col("y_pred")).alias("platform_baseline_mape"))
    best = F.when(F.col("platform_baseline_mape") < F.col("mean_baseline_mape"), "platform_baseline").otherwise("mean_baseline")
    return finalize(t.select("*", best.alias("best_baseline"),
                             F.least("mean_baseline_mape", "platform_baseline_mape").alias("best_baseline_mape")))


@register("k5_worst10_predictions", with_base_ctes(PRED_SQL, f"""
SELECT split_id, {KEYS_SQL}, {R('abs(y_pred - y_true) / (y_true + 1.0) * 100')} AS percentage_error FROM pred
ORDER BY abs(y_pred - y_true) / (y_true + 1.0) * 100 DESC, split_id, sales_month, {E}, product_code LIMIT 10"""))
def k5_worst(spark, d):
    e = mt.row_errors(predictions(spark, d))
    top = e.orderBy(F.desc("percentage_error"), "split_id", *KEYS).limit(10)
    return finalize(top.select("split_id", *KEYS, "percentage_error"))


@register("k6_top10_brands_mape", with_base_ctes(PRED_SQL + """,
top AS (SELECT brand_name FROM pred GROUP BY 1 ORDER BY count(*) DESC, brand_name LIMIT 10)""", f"""
SELECT brand_name, count(*) AS samples, {R('avg(abs(y_pred - y_true) / (y_true + 1.0) * 100)')} AS mean_ape
FROM pred WHERE brand_name IN (SELECT brand_name FROM top) GROUP BY 1"""))
def k6_brands(spark, d):
    e = mt.row_errors(predictions(spark, d))
    top = [b for (b,) in ix.top_keys(e, ["brand_name"], 10)]
    return finalize(e.where(F.col("brand_name").isin(top)).groupBy("brand_name").agg(
        F.count("*").alias("samples"), F.avg("percentage_error").alias("mean_ape")))


@register("k5_best10_predictions", with_base_ctes(PRED_SQL, f"""
SELECT split_id, {KEYS_SQL}, {R('abs(y_pred - y_true) / (y_true + 1.0) * 100')} AS percentage_error FROM pred
ORDER BY abs(y_pred - y_true) / (y_true + 1.0) * 100, split_id, sales_month, {E}, product_code LIMIT 10"""))
def k5_best(spark, d):
    """K5: the ten most exact predictions."""
    e = mt.row_errors(predictions(spark, d))
    return finalize(e.orderBy("percentage_error", "split_id", *KEYS).limit(10).select("split_id", *KEYS, "percentage_error"))


@register("k6_top10_stores_mape", with_base_ctes(PRED_SQL + """,
top AS (SELECT store_name FROM pred GROUP BY 1 ORDER BY count(*) DESC, store_name LIMIT 10)""", f"""
SELECT store_name, count(*) AS samples, {R('avg(abs(y_pred - y_true) / (y_true + 1.0) * 100)')} AS mean_ape
FROM pred WHERE store_name IN (SELECT store_name FROM top) GROUP BY 1"""))
def k6_stores(spark, d):
    """K6 for stores."""
    e = mt.row_errors(predictions(spark, d))
    top = [b for (b,) in ix.top_keys(e, ["store_name"], 10)]
    return finalize(e.where(F.col("store_name").isin(top)).groupBy("store_name").agg(
        F.count("*").alias("samples"), F.avg("percentage_error").alias("mean_ape")))


@register("x9_top10_brands", with_base_ctes(NOP, """
SELECT brand_name, count(*) AS n FROM base GROUP BY 1 ORDER BY n DESC, brand_name LIMIT 10"""))
def x9_brands(spark, d):
    """The ten brands with the most rows."""
    return finalize(base(spark, d).groupBy("brand_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "brand_name").limit(10))


@register("x16_split_platform_means", with_base_ctes(TAGGED, f"""
SELECT split_id, primary_platform, {R("avg(CASE WHEN role = 'train' THEN sales_quantity END)")} AS train_mean,
       {R("avg(CASE WHEN role = 'val' THEN sales_quantity END)")} AS val_mean FROM tagged GROUP BY 1, 2"""))
def x16_platform_means(spark, d):
    """Platform means of training and validation rows side by side."""
    b, y = base(spark, d), "sales_quantity"
    train = sp.train_moments(b, WINDOWS, [y], ["primary_platform"]).select("split_id", "primary_platform", F.col(f"{y}__mean").alias("train_mean"))
    val = sp.in_windows(b, WINDOWS, "val").groupBy("split_id", "primary_platform").agg(F.avg(y).alias("val_mean"))
    return finalize(train.join(val, ["split_id", "primary_platform"], "full"))


@register("x17_test_platform_share", with_base_ctes(PRED_SQL, f"""
SELECT split_id, primary_platform, count(*) AS rows, {R('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split_id)')} AS share_percent
FROM pred GROUP BY 1, 2"""))
def x17_platform_share(spark, d):
    """platforms' shares of the test rows."""
    from pyspark.sql import Window
    n = predictions(spark, d).groupBy("split_id", "primary_platform").agg(F.count("*").alias("rows"))
    return finalize(n.withColumn("share_percent", F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy("split_id"))))


_CLIPPED = {c: f"least(greatest(exp(ln(1 + {c})) - 1, 0.1), 1e6)" for c in ("y_true", "y_pred")}


@register("e14_platform_over_splits", with_base_ctes(PRED_SQL + f""",
ps AS (SELECT primary_platform, least(avg(abs({_CLIPPED['y_true']} - {_CLIPPED['y_pred']}) / ({_CLIPPED['y_true']} + 1.0)) * 100, 1000.0) AS m
       FROM pred GROUP BY split_id, primary_platform)""", f"""
SELECT primary_platform, {R('avg(m)')} AS mean_mape, {R('stddev_pop(m)')} AS std_mape, {R('min(m)')} AS min_mape,
       {R('max(m)')} AS max_mape, count(*) AS splits_analyzed FROM ps GROUP BY 1"""))
def e14_over_splits(spark, d):
    """Platform errors over the splits."""
    return finalize(mt.platform_over_splits(predictions(spark, d)))


for _key in ("brand_name", "store_name"):
    register(f"e16_metrics_by_{_key.split('_')[0]}", with_base_ctes(PRED_SQL, f"""
SELECT {_key}, {_metric_sql()} FROM pred GROUP BY 1"""))(
        lambda spark, d, key=_key: finalize(mt.metrics_by(predictions(spark, d), [key])))

#: The evaluator's assumed MAPE of the model.
EXPECTED_MAPE = 4.86


@register("e23_improvement_over_baselines", with_base_ctes(PRED_SQL + """,
b AS (SELECT split_id,
             avg(abs(least(greatest(y_true, 1), 1e6) - least(greatest(y_pred_mean, 1), 1e6)) / (least(greatest(y_true, 1), 1e6) + 1)) * 100 AS a,
             avg(abs(least(greatest(y_true, 1), 1e6) - least(greatest(y_pred, 1), 1e6)) / (least(greatest(y_true, 1), 1e6) + 1)) * 100 AS c
      FROM pred GROUP BY 1),
m AS (SELECT *, least(CASE WHEN a < 1000 THEN a END, CASE WHEN c < 1000 THEN c END) AS best FROM b)""", f"""
SELECT split_id, {R('a')} AS mean_baseline_mape, {R('c')} AS platform_baseline_mape, {R('best')} AS best_baseline_mape,
       {R(f'best / {EXPECTED_MAPE}')} AS improvement_factor, 'Outstanding' AS business_assessment FROM m"""))
def e23_improvement(spark, d):
    """Best baseline under 1000, improvement factor and assessment."""
    y = F.col("y_true")
    t = predictions(spark, d).groupBy("split_id").agg(mt.evaluator_mape(y, F.col("y_pred_mean")).alias("mean_baseline_mape"),
                                                      mt.evaluator_mape(y, F.col("y_pred")).alias("platform_baseline_mape"))
    return finalize(mt.baseline_summary(t, ["mean_baseline_mape", "platform_baseline_mape"], EXPECTED_MAPE))


@register("k7_best_worst_split", with_base_ctes(PRED_SQL + f""",
ps AS (SELECT split_id, {_metric_sql()} FROM pred GROUP BY 1)""", """
SELECT arg_min(split_id, (mape, split_id)) AS best_split, arg_max(split_id, (mape, -split_id)) AS worst_split FROM ps"""))
def k7_best_worst(spark, d):
    per = mt.metrics_by(predictions(spark, d), ["split_id"])
    return finalize(per.agg(F.min_by("split_id", F.struct("mape", "split_id")).alias("best_split"),
                            F.max_by("split_id", F.struct("mape", (-F.col("split_id")).alias("s"))).alias("worst_split")))


CUT = sp.cutoff_windows(1999)


def _cut_sql():
    rows = []
    for k, ts, te, vs, ve, desc in CUT:
        rows.append(f"({k}, 'train', DATE '{ts}', DATE '{te}')")
        rows.append(f"({k}, 'val', DATE '{vs}', DATE '{ve}')")
    return f"win(split_id, role, lo, hi) AS (VALUES {', '.join(rows)})"


@register("l2_cutoff_split_summary", with_base_ctes(_cut_sql(), f"""
SELECT split_id, role, count(*) AS rows, {D('min(sales_month)')} AS start, {D('max(sales_month)')} AS "end",
       count(DISTINCT sales_month) AS months
FROM base JOIN win ON sales_month >= lo AND sales_month < hi GROUP BY 1, 2"""))
def l2_cutoff(spark, d):
    t = sp.tag_splits(base(spark, d), CUT)
    s = sp.split_summary(t).drop("ordered")
    return finalize(s)


@register("m3_year_index", with_base_ctes(TAGGED, """
SELECT t.split_id, t.role, t.year, coalesce(CAST(m.year_index AS INTEGER), 0) AS year_index, t.rows
FROM (SELECT split_id, role, CAST(year(sales_month) AS INTEGER) AS year, count(*) AS rows FROM tagged GROUP BY ALL) t
LEFT JOIN (SELECT split_id, year, dense_rank() OVER (PARTITION BY split_id ORDER BY year) - 1 AS year_index
           FROM (SELECT DISTINCT split_id, CAST(year(sales_month) AS INTEGER) AS year FROM tagged WHERE role = 'train')) m
     ON t.split_id = m.split_id AND t.year = m.year"""))
def m3_year(spark, d):
    t = tagged(spark, d).withColumn("year", F.year("sales_month"))
    rows = t.groupBy("split_id", "role", "year").agg(F.count("*").alias("rows"))
    return finalize(en.apply_year_map(rows, en.fit_year_map(t.where(F.col("role") == "train")))
                    .select("split_id", "role", "year", "year_index", "rows"))


@register("m6_minmax_fit", with_base_ctes(TAGGED, f"""
SELECT split_id, {R('min(sales_quantity)')} AS sales_quantity__min, {R('min(unit_price)')} AS unit_price__min,
       {R('max(sales_quantity)')} AS sales_quantity__max, {R('max(unit_price)')} AS unit_price__max
FROM tagged WHERE role = 'train' GROUP BY 1"""))
def m6_minmax(spark, d):
    t = tagged(spark, d).where(F.col("role") == "train")
    return finalize(en.fit_minmax(t, ["sales_quantity", "unit_price"]))


FLAGS = ["has_missing_price", "has_zero_sales", "has_high_price"]
LAG_FEATURES = [f"{p}_lag_{k}" for k in tp.LAGS for p in ("sales", "amount", "price")]
SCREENED = ["sales_amount", "unit_price", *FLAGS, "month", "quarter", "year", *LAG_FEATURES]


def screened_features(spark, d):
    """Numeric columns of the fact, calendar parts and lags."""
    rows = skew.chunked(base(spark, d), lambda x, e: tp.lag_features(x, entity=e))
    m = F.col("sales_month")
    return rows.select("sales_quantity", "sales_quantity_log", "sales_amount", "unit_price", *FLAGS, F.month(m).alias("month"),
                       F.quarter(m).alias("quarter"), F.year(m).alias("year"), *LAG_FEATURES)


_LAG_SOURCE = {"sales": "sales_quantity", "amount": "sales_amount", "price": "unit_price"}


def screened_shifts(spark, d, cols):
    """Numbers near the means of ``cols``, from the persisted base: a lag has its source's
    mean, so that the windows run once, not for the means too."""
    m = F.col("sales_month")
    b = base(spark, d).select("*", F.month(m).alias("month"), F.quarter(m).alias("quarter"), F.year(m).alias("year"))
    own = [_LAG_SOURCE[c.split("_")[0]] if c in LAG_FEATURES else c for c in cols]
    source = sorted(set(own))
    means = dict(zip(source, gram._means(b, source)))
    return [means[c] for c in own]


_LAGS = ", ".join(f"coalesce(lag({c}, {k}) OVER w, 0) AS {p}_lag_{k}" for k in tp.LAGS
                  for p, c in (("sales", "sales_quantity"), ("amount", "sales_amount"), ("price", "unit_price")))
SCREENED_SQL = f"""screened AS (SELECT *, month(sales_month) AS month, quarter(sales_month) AS quarter, year(sales_month) AS year, {_LAGS}
  FROM base WINDOW w AS (PARTITION BY primary_platform, store_name, brand_name ORDER BY sales_month, product_code))"""
M11_COLS = ["sales_quantity", *SCREENED]


def _corr_sql(pairs):
    names = "[" + ", ".join(f"'{a}'" for a, _ in pairs) + "], [" + ", ".join(f"'{b}'" for _, b in pairs) + "]"
    values = ", ".join(f"corr({a}, {b})" for a, b in pairs)
    return f"""corrs AS (SELECT unnest(a) AS feature_a, unnest(b) AS feature_b, unnest(r) AS r
  FROM (SELECT {names.replace('], [', '] AS a, [')} AS b, [{values}] AS r FROM screened)),
cleaned AS (SELECT feature_a, feature_b, CASE WHEN isfinite(r) THEN r END AS r FROM corrs)"""


@register("m11_correlation_matrix", with_base_ctes(SCREENED_SQL + ",\n" + _corr_sql([(a, b) for a in M11_COLS for b in M11_COLS]), f"""
SELECT feature_a, feature_b, {R('r')} AS corr FROM cleaned"""))
def m11_corr(spark, d):
    """M11 over all numeric columns, calendar parts and lags."""
    return finalize(gram.correlations(screened_features(spark, d), M11_COLS, screened_shifts(spark, d, M11_COLS)).drop("n"))


@register("q3_high_correlation_pairs", with_base_ctes(SCREENED_SQL + ",\n" + _corr_sql(
    [(a, b) for a in M11_COLS for b in M11_COLS if a < b]), f"""
SELECT feature_a, feature_b, {R('r')} AS corr FROM cleaned WHERE abs(r) > 0.95"""))
def q3_pairs(spark, d):
    """Q3: pairs of features that tell the same."""
    return finalize(gram.high_pairs(gram.correlations(screened_features(spark, d), M11_COLS, screened_shifts(spark, d, M11_COLS))))


@register("m16_linear_regression_holdout")
def m16_linear(spark, d):
    """M16 elastic-net linear model per split on standardised inputs, scored on validation rows
    (rows-only check)."""
    m = F.col("sales_month")
    rows = base(spark, d).select(m, F.month(m).alias("month"), F.year(m).alias("year"), "unit_price", "sales_quantity_log")
    return holdout_metrics(rows, ["month", "year", "unit_price"], "linear", regParam=1.0, elasticNetParam=0.5)


@register("a35_store_behaviour_v1", with_base_ctes("""
g AS (SELECT store_name, primary_platform, avg(sales_quantity) AS m, stddev_samp(sales_quantity) AS s, count(sales_quantity) AS n,
             min(sales_quantity) AS lo, max(sales_quantity) AS hi, sum(sales_amount) AS amt, sum(sales_quantity) AS qty,
             count(DISTINCT brand_name) AS store_brand_diversity, count(DISTINCT product_code) AS store_product_diversity,
             avg(unit_price) AS p FROM base GROUP BY 1, 2),
e AS (SELECT list_sort(list_distinct(list_concat([min(n * m)], quantile_cont(n * m, [0.2, 0.4, 0.6, 0.8]), [max(n * m)]))) AS edges FROM g)""", f"""
SELECT store_name, primary_platform, {R('CASE WHEN m <> 0 AND s IS NOT NULL THEN s / m ELSE 0 END')} AS store_sales_cv_v1,
       {R('hi - lo')} AS store_sales_range_v1, {R('CASE WHEN qty <> 0 THEN amt / qty END')} AS store_revenue_per_unit,
       store_brand_diversity, store_product_diversity, {R('p / (SELECT avg(p) FROM g)')} AS store_price_premium,
       {R('n * m')} AS store_size_metric,
       ['Micro', 'Small', 'Medium', 'Large', 'Mega'][greatest(len(list_filter(edges, lambda x: x < n * m)), 1)] AS store_size_category
FROM g, e"""))
def a35_store_v1(spark, d):
    """A35 v1 store profile with quintile size labels (right-closed bins between the distinct quintile edges)."""
    return finalize(st.store_behaviour_v1(base(spark, d)))


Q3_COLS = ["sales_amount", "sales_quantity", "unit_price", "has_high_price", "has_zero_sales"]


def _q3_sql():
    parts = []
    for c in Q3_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS feature, avg(CAST({c} IS NULL AS DOUBLE)) AS null_ratio,
       CAST(count_if(abs({x}) = 'Infinity'::DOUBLE) AS DOUBLE) AS infinite,
       CASE WHEN count({x}) > 2 AND NOT isnan(skewness({x})) THEN skewness({x}) END AS skewness,
       CASE WHEN NOT isnan(corr({x}, sales_quantity_log)) THEN abs(corr({x}, sales_quantity_log)) END AS ac,
       coalesce(stddev_pop({x}), 0) = 0 AS zv FROM base""")
    body = " UNION ALL ".join(parts)
    return with_base_ctes(NOP, f"""
SELECT feature, {R('null_ratio')} AS null_ratio, {R('infinite')} AS infinite, {R('skewness')} AS skewness,
       {R('ac')} AS abs_corr_target, CAST(zv AS INTEGER) AS zero_variance, CAST(null_ratio > 0.1 AS INTEGER) AS high_null,
       CAST(coalesce(abs(skewness) > 3, false) AS INTEGER) AS high_skew,
       CAST(coalesce(ac < 0.01, false) AS INTEGER) AS weak_target FROM ({body})""")


@register("q3_feature_validation", _q3_sql())
def q3_validation(spark, d):
    return finalize(qa.validate_features(base(spark, d), Q3_COLS))


@register("x11_store_distribution", with_base_ctes(NOP, f"""
SELECT primary_platform, count(DISTINCT store_name) AS stores,
       count(DISTINCT CASE WHEN store_name IS NOT NULL THEN brand_name END) AS brands,
       {R('sum(sales_quantity)')} AS quantity FROM base GROUP BY 1"""))
def x11_store_distribution(spark, d):
    b = base(spark, d)
    return finalize(b.groupBy("primary_platform").agg(
        F.count_distinct("store_name").alias("stores"),
        F.count_distinct(F.when(F.col("store_name").isNotNull(), F.col("brand_name"))).alias("brands"),
        F.sum("sales_quantity").alias("quantity")))


@register("x12_competitive_landscape", with_base_ctes("""
bp AS (SELECT brand_name, count(DISTINCT primary_platform) AS np FROM base GROUP BY 1)""", """
SELECT CASE WHEN np >= 3 THEN '3+' ELSE CAST(np AS VARCHAR) END AS platform_reach, count(*) AS brands FROM bp GROUP BY 1"""))
def x12_landscape(spark, d):
    bp = base(spark, d).groupBy("brand_name").agg(F.count_distinct("primary_platform").alias("np"))
    reach = F.when(F.col("np") >= 3, F.lit("3+")).otherwise(F.col("np").cast("string"))
    return finalize(bp.groupBy(reach.alias("platform_reach")).agg(F.count("*").alias("brands")))


@register("x16_split_monthly_means", with_base_ctes(TAGGED, f"""
SELECT split_id, role, CAST(month(sales_month) AS INTEGER) AS month, {R('avg(sales_quantity)')} AS mean_quantity,
       count(*) AS rows FROM tagged GROUP BY 1, 2, 3"""))
def x16_split_means(spark, d):
    t = tagged(spark, d)
    return finalize(t.groupBy("split_id", "role", F.month("sales_month").alias("month")).agg(
        F.avg("sales_quantity").alias("mean_quantity"), F.count("*").alias("rows")))


@register("x17_test_characteristics", with_base_ctes(PRED_SQL, f"""
SELECT split_id, {R('avg(y_true)')} AS mean, {R('quantile_cont(y_true, 0.5)')} AS median, {R('stddev_samp(y_true)')} AS std,
       {R('min(y_true)')} AS min, {R('max(y_true)')} AS max FROM pred GROUP BY 1"""))
def x17_test_chars(spark, d):
    p = predictions(spark, d)
    y = F.col("y_true")
    medians = group_quantiles(p, ["split_id"], ["y_true"], [0.5]).select("split_id", F.col("q")[0].alias("median"))
    return finalize(p.groupBy("split_id").agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.min(y).alias("min"),
                                              F.max(y).alias("max")).join(medians, "split_id"))


@register("pipeline_engineer_all")
def pipeline_engineer_all(spark, d):
    """The six-step feature build over the whole sales view (rows-only: ~330 columns)."""
    from ..sources.tpch import sales_from_tpch
    from .pipeline import engineer_all
    return finalize(engineer_all(sales_from_tpch(spark, d, by_product=True)))


@register("x14_sales_by_month", with_base_ctes(NOP, f"""
SELECT CAST(month(sales_month) AS INTEGER) AS month, {R('avg(sales_quantity)')} AS mean_quantity,
       {R('quantile_cont(sales_quantity, 0.5)')} AS median_quantity, count(sales_quantity) AS rows FROM base GROUP BY 1"""))
def x14_by_month(spark, d):
    from ..operators import explore as xp
    return finalize(xp.sales_patterns(base(spark, d), [F.month("sales_month").alias("month")]))


@register("x18_promo_month_effect", with_base_ctes(NOP, f"""
SELECT CAST(month(sales_month) IN (1, 6, 9, 11, 12) AS INTEGER) AS is_promo_month,
       {R('avg(sales_quantity)')} AS mean_quantity, {R('quantile_cont(sales_quantity, 0.5)')} AS median_quantity,
       count(sales_quantity) AS rows FROM base GROUP BY 1"""))
def x18_promo(spark, d):
    from ..operators import explore as xp
    b = base(spark, d).withColumn("is_promo_month", F.month("sales_month").isin(1, 6, 9, 11, 12).cast("int"))
    return finalize(xp.sales_patterns(b, ["is_promo_month"]))


@register("q11_high_outliers", with_base_ctes("qq AS (SELECT quantile_cont(sales_quantity, 0.99) AS thr FROM base)", f"""
SELECT {R('any_value(thr)')} AS threshold, CAST(count_if(sales_quantity > thr) AS BIGINT) AS outliers,
       {R('avg(CAST(sales_quantity > thr AS DOUBLE))')} AS outlier_share FROM base, qq"""))
def q11_outliers(spark, d):
    return finalize(qa.high_outliers(base(spark, d)))


@register("e22_performance_table", with_base_ctes(PRED_SQL + f""",
ps AS (SELECT split_id, {_metric_sql()} FROM pred GROUP BY 1)""", """
SELECT ps.*, CASE WHEN mape <= 15 THEN 'EXCELLENT' WHEN mape <= 20 THEN 'GOOD' WHEN mape <= 30 THEN 'FAIR'
                  ELSE 'POOR' END AS grade FROM ps"""))
def e22_table(spark, d):
    return finalize(mt.performance_table(mt.metrics_by(predictions(spark, d), ["split_id"])))


HOLD = sp.holdout_year_windows([1999, 2000], 2001)


@register("l6_holdout_year_summary", with_base_ctes(f"""
win(split_id, role, lo, hi) AS (VALUES (1, 'train', DATE '{HOLD[0][1]}', DATE '{HOLD[0][2]}'),
                                       (1, 'val', DATE '{HOLD[0][3]}', DATE '{HOLD[0][4]}'))""", f"""
SELECT split_id, role, count(*) AS rows, {D('min(sales_month)')} AS start, {D('max(sales_month)')} AS "end",
       count(DISTINCT sales_month) AS months
FROM base JOIN win ON sales_month >= lo AND sales_month < hi GROUP BY 1, 2"""))
def l6_holdout(spark, d):
    return finalize(sp.split_summary(sp.tag_splits(base(spark, d), HOLD)).drop("ordered"))


def _k4(n):
    return with_base_ctes(SCREENED_SQL + ",\n" + _corr_sql([(f, "sales_quantity_log") for f in SCREENED]), f"""
SELECT feature_a AS feature, {R('abs(r)')} AS abs_corr FROM cleaned ORDER BY abs(r) DESC NULLS LAST, feature LIMIT {n}""")


def _target_shifts(spark, d):
    return screened_shifts(spark, d, [*SCREENED, "sales_quantity_log"])


@register("k4_top_correlated_features", _k4(10))
def k4_top(spark, d):
    """K4: the ten features most correlated with the target."""
    return finalize(md.top_correlated(md.target_correlations(screened_features(spark, d), SCREENED, shifts=_target_shifts(spark, d)), 10))


@register("k4_top20_correlated_features", _k4(20))
def k4_top20(spark, d):
    """K4 at twenty."""
    return finalize(md.top_correlated(md.target_correlations(screened_features(spark, d), SCREENED, shifts=_target_shifts(spark, d)), 20))


@register("m10_target_correlations", with_base_ctes(SCREENED_SQL + ",\n" + _corr_sql([(f, "sales_quantity_log") for f in SCREENED]), f"""
SELECT feature_a AS feature, {R('abs(r)')} AS abs_corr FROM cleaned"""))
def m10_correlations(spark, d):
    """Every screened feature with the target."""
    return finalize(md.target_correlations(screened_features(spark, d), SCREENED, shifts=_target_shifts(spark, d)))


def _x10_sql():
    from .q_dims import _n1_sql
    sql = _n1_sql()
    head = sql[:sql.rindex("\nSELECT store_name, store_type,")]
    return head + f"""
SELECT store_type, primary_platform, count(*) AS rows, {R('sum(sales_quantity)')} AS quantity,
       count(DISTINCT base.store_name) AS stores
FROM base JOIN ty ON base.store_name IS NOT DISTINCT FROM ty.store_name GROUP BY 1, 2"""


@register("x10_store_type_by_platform", _x10_sql())
def x10_type_platform(spark, d):
    from ..operators import explore as xp
    b = base(spark, d, True)
    types = st.store_types(b).select(F.col("store_name").alias("_t_store"), "store_type")
    typed = b.join(types, b["store_name"].eqNullSafe(types["_t_store"])).drop("_t_store")
    return finalize(xp.store_type_by_platform(typed))


@register("x15_month_promo_pattern", with_base_ctes(NOP, f"""
SELECT CAST(month(sales_month) AS INTEGER) AS month, CAST(month(sales_month) IN (1, 6, 9, 11, 12) AS INTEGER) AS is_promo_month,
       {R('avg(sales_quantity)')} AS mean_quantity, {R('quantile_cont(sales_quantity, 0.5)')} AS median_quantity,
       count(sales_quantity) AS rows FROM base GROUP BY 1, 2"""))
def x15_pattern(spark, d):
    from ..operators import explore as xp
    b = base(spark, d).withColumn("is_promo_month", F.month("sales_month").isin(1, 6, 9, 11, 12).cast("int"))
    return finalize(xp.sales_patterns(b, [F.month("sales_month").alias("month"), "is_promo_month"]))

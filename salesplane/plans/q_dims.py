"""Registered queries: dimension aggregates (A*), store / platform blocks, top-k and interactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import behaviour as bh
from ..operators import calendar as cal
from ..operators import explore as ex
from ..operators import interactions as ix
from ..operators import platforms as pf
from ..operators import stores as st
from .base import D, R, base, finalize, with_base_ctes
from .catalog import register

E = "primary_platform, store_name, brand_name"
ST = "primary_platform, store_name"


def I(cond):  # noqa: E743 - flag in SQL
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def CENTS(c):
    return f"CAST(SUM(CAST(ROUND({c} * 100) AS BIGINT)) AS DOUBLE) / 100"


def q(sparse, ctes, body):
    return with_base_ctes(ctes, body, sparse)


# ------------------------------------------------------------ A1 - A10 -------

register("a1_store_behaviour", q(False, f"""
t AS (SELECT {ST}, avg(sales_quantity) AS m, stddev_samp(sales_quantity) AS s, min(sales_quantity) AS mn,
             max(sales_quantity) AS mx, count(sales_quantity) AS n, avg(sales_amount) AS am,
             stddev_samp(sales_amount) AS asd, avg(unit_price) AS pm, stddev_samp(unit_price) AS psd,
             count(DISTINCT brand_name) AS nb, count(DISTINCT product_code) AS np
      FROM base GROUP BY ALL),
qq AS (SELECT quantile_cont(m, 0.33) AS q33, quantile_cont(m, 0.67) AS q67 FROM t)""", f"""
SELECT {ST}, {R('m')} AS store_sales_mean, {R('s')} AS store_sales_std, {R('mn')} AS store_sales_min,
       {R('mx')} AS store_sales_max, n AS store_record_count, {R('am')} AS store_amount_mean,
       {R('asd')} AS store_amount_std, {R('pm')} AS store_price_mean, {R('psd')} AS store_price_std,
       nb AS store_brand_count, np AS store_product_count, {R('s / (m + 1)')} AS store_sales_cv,
       {R('mx - mn')} AS store_sales_range, {R('psd / (pm + 1)')} AS store_price_cv,
       {I('s / (m + 1) < 0.5')} AS store_consistency_high,
       {I('s / (m + 1) >= 0.5 AND s / (m + 1) < 1.0')} AS store_consistency_medium,
       {I('s / (m + 1) >= 1.0')} AS store_consistency_low,
       {I('m <= q33')} AS store_size_small, {I('m > q33 AND m <= q67')} AS store_size_medium,
       {I('m > q67')} AS store_size_large
FROM t, qq"""))(lambda spark, d: finalize(bh.store_behaviour(base(spark, d))))

register("a2_brand_analysis", q(False, f"""
tot AS (SELECT sum(sales_quantity) AS tq, {CENTS('sales_amount')} AS ta, count(DISTINCT store_name) AS ns,
               count(DISTINCT primary_platform) AS np, avg(unit_price) AS mp FROM base),
t AS (SELECT brand_name, avg(sales_quantity) AS m, stddev_samp(sales_quantity) AS s, sum(sales_quantity) AS tq_b,
             avg(sales_amount) AS am, {CENTS('sales_amount')} AS ta_b, avg(unit_price) AS pm,
             stddev_samp(unit_price) AS psd, count(DISTINCT store_name) AS bs, count(DISTINCT primary_platform) AS bp,
             count(DISTINCT product_code) AS bpr FROM base GROUP BY brand_name),
qq AS (SELECT quantile_cont(m, 0.25) AS q25, quantile_cont(m, 0.75) AS q75 FROM t)""", f"""
SELECT brand_name, {R('m')} AS brand_sales_mean, {R('s')} AS brand_sales_std, {R('tq_b')} AS brand_sales_total,
       {R('am')} AS brand_amount_mean, {R('ta_b')} AS brand_amount_total, {R('pm')} AS brand_price_mean,
       {R('psd')} AS brand_price_std, bs AS brand_store_count, bp AS brand_platform_count,
       bpr AS brand_product_count, {R('tq_b / tq')} AS brand_market_share_quantity,
       {R('ta_b / ta')} AS brand_market_share_amount, {R('bs / ns')} AS brand_diversity_stores,
       {R('bp / np')} AS brand_diversity_platforms, {I('pm > mp * 1.2')} AS brand_premium_indicator,
       {I('pm < mp * 0.8')} AS brand_budget_indicator,
       {I('pm >= mp * 0.8 AND pm <= mp * 1.2')} AS brand_mid_range_indicator,
       {I('m <= q25')} AS brand_performance_low, {I('m > q25 AND m <= q75')} AS brand_performance_medium,
       {I('m > q75')} AS brand_performance_high
FROM t, tot, qq"""))(lambda spark, d: finalize(bh.brand_analysis(base(spark, d))))

register("a3_store_brand_diversity", q(False, f"""
t AS (SELECT {E}, count(DISTINCT product_code) AS n, sum(sales_quantity) AS sq, {CENTS('sales_amount')} AS sa
      FROM base GROUP BY ALL),
qq AS (SELECT quantile_cont(n, 0.33) AS q33, quantile_cont(n, 0.67) AS q67 FROM t)""", f"""
SELECT {E}, n AS product_diversity_count, {R('sq')} AS sb_total_quantity, {R('sa')} AS sb_total_amount,
       {I('n <= q33')} AS product_diversity_low, {I('n > q33 AND n <= q67')} AS product_diversity_medium,
       {I('n > q67')} AS product_diversity_high, {R('sq / n')} AS avg_sales_per_product
FROM t, qq"""))(lambda spark, d: finalize(bh.store_brand_diversity(base(spark, d))))

register("a4_product_stats", q(False, "t AS (SELECT 1)", f"""
SELECT product_code, {R('avg(sales_quantity)')} AS product_sales_mean,
       {R('stddev_samp(sales_quantity)')} AS product_sales_std, {R('sum(sales_quantity)')} AS product_sales_total,
       {R('avg(unit_price)')} AS product_price_mean, count(DISTINCT store_name) AS product_store_count,
       count(DISTINCT primary_platform) AS product_platform_count,
       {I('count(DISTINCT store_name) > 1')} AS product_multi_store,
       {I('count(DISTINCT primary_platform) > 1')} AS product_multi_platform
FROM base WHERE product_code IS NOT NULL GROUP BY product_code"""))(
    lambda spark, d: finalize(bh.product_stats(base(spark, d))))

register("a5_platform_share", q(False, "tot AS (SELECT sum(sales_quantity) AS t FROM base)", f"""
SELECT primary_platform, {R('sum(sales_quantity)')} AS platform_total,
       {R('sum(sales_quantity) / any_value(t)')} AS platform_market_share
FROM base, tot GROUP BY primary_platform"""))(lambda spark, d: finalize(bh.platform_share(base(spark, d))))


def _share_sql(key, prefix):
    return q(False, f"""
plat AS (SELECT primary_platform, sum(sales_quantity) AS platform_total FROM base GROUP BY 1),
t AS (SELECT primary_platform, {key}, sum(sales_quantity) AS tot FROM base GROUP BY 1, 2)""", f"""
SELECT t.primary_platform, {key}, {R('tot')} AS {prefix}_platform_total,
       {R('tot / platform_total')} AS {prefix}_platform_market_share,
       {I('tot / platform_total > 0.1')} AS dominant_{prefix},
       {I('tot / platform_total > 0.3')} AS highly_concentrated_{prefix}
FROM t JOIN plat USING (primary_platform)""")


register("a6_store_share_in_platform", _share_sql("store_name", "store"))(
    lambda spark, d: finalize(bh.store_share_in_platform(base(spark, d))))
register("a7_brand_share_in_platform", _share_sql("brand_name", "brand"))(
    lambda spark, d: finalize(bh.brand_share_in_platform(base(spark, d))))

register("a9_loyalty", q(False, f"""
t AS (SELECT {E}, count(sales_month) AS n,
             CAST(round(CAST(max(sales_month) - min(sales_month) AS INTEGER) / 30.44) AS INTEGER) AS dur
      FROM base GROUP BY ALL)""", f"""
SELECT {E}, dur AS relationship_duration_months, {R('n / (dur + 1)')} AS relationship_consistency,
       {I('dur >= 12')} AS long_term_relationship, {I('dur >= 6 AND dur < 12')} AS medium_term_relationship,
       {I('dur < 6')} AS short_term_relationship, {I('n / (dur + 1) > 0.8')} AS high_consistency_relationship
FROM t"""))(lambda spark, d: finalize(bh.loyalty(base(spark, d))))

register("a10_performance_categories", q(False, f"""
t AS (SELECT {E}, avg(sales_quantity) AS m, stddev_samp(sales_quantity) / (avg(sales_quantity) + 1) AS cv
      FROM base GROUP BY ALL),
qq AS (SELECT quantile_cont(m, 0.33) AS q33, quantile_cont(m, 0.67) AS q67, quantile_cont(cv, 0.5) AS med FROM t)""",
    f"""
SELECT {E}, {R('cv')} AS entity_sales_cv, {I('m > q67 AND cv < med')} AS high_performer,
       {I('m > q33 AND m <= q67 AND cv < med')} AS steady_performer,
       {I('m > q67 AND cv >= med')} AS volatile_performer, {I('m <= q33')} AS low_performer
FROM t, qq"""))(lambda spark, d: finalize(bh.performance_categories(base(spark, d))))


# ------------------------------------------------------------ N, A11 - A17 ----

def _n1_types_sql():
    """CTE ty (store_name, store_type) and the type and weight arrays."""
    arr, types, weights = [], [], []
    for ty, w, kws in st.K.STORE_TYPE_KEYWORDS:
        hits = " + ".join(f"CAST(contains(lower(coalesce(store_name, '')), '{k.lower()}') AS INTEGER)" for k in kws)
        arr.append(f"(({hits}) * {w})")
        types.append(f"'{ty}'")
        weights.append(str(float(w)))
    types = f"[{', '.join(types)}]"
    return f"""
s AS (SELECT DISTINCT store_name FROM base),
sc AS (SELECT store_name, [{', '.join(arr)}] AS sc FROM s),
ty AS (SELECT store_name, CASE WHEN list_max(sc) > 0 THEN {types}[list_position(sc, list_max(sc))]
                          ELSE '{st.K.STORE_TYPE_DEFAULT}' END AS store_type FROM sc)""", types, f"[{', '.join(weights)}]"


def _n1_sql():
    ctes, types, weights = _n1_types_sql()
    onehot = ", ".join(f"{I(f'store_type = {chr(39)}{t}{chr(39)}')} AS store_type_{t}" for t, _, _ in st.K.STORE_TYPE_KEYWORDS)
    return q(True, ctes, f"""
SELECT store_name, store_type, {onehot}, {R(f'{weights}[list_position({types}, store_type)]')} AS store_type_score
FROM ty""")


register("n1_store_types", _n1_sql())(lambda spark, d: finalize(st.store_types(base(spark, d, True))))


def _n3_sql():
    case = " ".join(f"WHEN {' OR '.join(f'contains(store_name, {chr(39)}{s}{chr(39)})' for s in subs)} THEN '{lab}'"
                    for subs, lab in st.K.STORE_TYPE_RULES_V1)
    labels = [lab for _, lab in st.K.STORE_TYPE_RULES_V1] + [st.K.STORE_TYPE_V1_OTHER, st.K.STORE_TYPE_V1_NULL]
    onehot = ", ".join(f"{I(f'store_type_v1 = {chr(39)}{lab}{chr(39)}')} AS store_type_v1_{lab.lower().replace(' ', '_')}"
                       for lab in labels)
    return q(True, f"""
t AS (SELECT store_name, CASE WHEN store_name IS NULL THEN '{st.K.STORE_TYPE_V1_NULL}' {case}
                              ELSE '{st.K.STORE_TYPE_V1_OTHER}' END AS store_type_v1
      FROM (SELECT DISTINCT store_name FROM base))""", f"SELECT store_name, store_type_v1, {onehot} FROM t")


register("n3_store_type_v1", _n3_sql())(lambda spark, d: finalize(st.store_type_v1(base(spark, d, True))))

register("a11_multi_platform", q(True, """
sp AS (SELECT store_name, primary_platform, sum(sales_quantity) AS q FROM base GROUP BY 1, 2)""", f"""
SELECT store_name, count(*) AS store_multi_platform, {I('count(*) > 1')} AS store_multi_platform_binary,
       arg_min(primary_platform, (-q, primary_platform)) AS dominant_platform
FROM sp GROUP BY store_name"""))(lambda spark, d: finalize(st.multi_platform(base(spark, d, sparse=True))))


def _mm(c, inv=False):
    x = f"(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-6))"
    return f"(1 - {x})" if inv else x


register("a13_store_quality", q(True, f"""
t AS (SELECT {ST}, stddev_samp(sales_quantity) / (avg(sales_quantity) + 1) AS c,
             CAST(count(DISTINCT brand_name) * count(DISTINCT product_code) AS DOUBLE) AS dv,
             CAST(count(DISTINCT sales_month) AS DOUBLE) AS lg, sum(sales_quantity) AS vol
      FROM base GROUP BY ALL),
s AS (SELECT {ST}, {_mm('c', True)} * 0.3 + {_mm('dv')} * 0.2 + {_mm('lg')} * 0.2 + {_mm('vol')} * 0.3 AS sc FROM t),
qq AS (SELECT quantile_cont(sc, 0.33) AS q33, quantile_cont(sc, 0.67) AS q67 FROM s)""", f"""
SELECT {ST}, {R('sc')} AS store_quality_score, {I('sc > q67')} AS store_quality_high,
       {I('sc > q33 AND sc <= q67')} AS store_quality_medium, {I('sc <= q33')} AS store_quality_low,
       {I('sc > 0.7')} AS store_trust_high FROM s, qq"""))(
    lambda spark, d: finalize(st.store_quality(base(spark, d, sparse=True))))

register("a15_business_model", q(True, f"""
t AS (SELECT {ST}, count(DISTINCT brand_name) AS b, avg(unit_price) AS pm, stddev_samp(unit_price) AS ps,
             sum(sales_quantity) AS tot FROM base GROUP BY ALL),
qq AS (SELECT quantile_cont(tot, 0.8) AS v80, quantile_cont(pm, 0.2) AS p20, quantile_cont(pm, 0.8) AS p80 FROM t)""",
    f"""
SELECT {ST}, {I('b >= 5')} AS bm_multi_brand_retailer, {I('b = 1')} AS bm_single_brand_specialist,
       {I('b >= 2 AND b <= 4')} AS bm_limited_brand_specialist, {I('tot > v80')} AS bm_high_volume_retailer,
       {I('pm > p80')} AS bm_premium_retailer, {I('pm < p20')} AS bm_budget_retailer,
       {I('ps / (pm + 1) < 0.3')} AS bm_consistent_pricing, {I('ps / (pm + 1) > 0.7')} AS bm_diverse_pricing
FROM t, qq"""))(lambda spark, d: finalize(st.business_model(base(spark, d, sparse=True))))

register("a16_competition", q(True, "t AS (SELECT 1)", f"""
SELECT primary_platform, brand_name, count(DISTINCT store_name) AS competing_stores,
       {R('sum(sales_quantity)')} AS total_brand_sales, {I('count(DISTINCT store_name) <= 2')} AS competition_low,
       {I('count(DISTINCT store_name) > 2 AND count(DISTINCT store_name) <= 5')} AS competition_medium,
       {I('count(DISTINCT store_name) > 5')} AS competition_high
FROM base GROUP BY 1, 2"""))(lambda spark, d: finalize(st.competition(base(spark, d, sparse=True))))


def _share_flags_sql(s, prefix, names=("leader", "major", "minor", "niche")):
    return (f"{I(f'{s} > 0.5')} AS {prefix}_{names[0]}, {I(f'{s} > 0.2 AND {s} <= 0.5')} AS {prefix}_{names[1]}, "
            f"{I(f'{s} > 0.05 AND {s} <= 0.2')} AS {prefix}_{names[2]}, {I(f'{s} <= 0.05')} AS {prefix}_{names[3]}")


register("a17_store_share_in_brand", q(True, f"""
t AS (SELECT primary_platform, brand_name, store_name, sum(sales_quantity) AS s FROM base GROUP BY ALL),
u AS (SELECT *, s / sum(s) OVER (PARTITION BY primary_platform, brand_name) AS sh FROM t)""", f"""
SELECT primary_platform, brand_name, store_name, {R('s')} AS store_brand_sales, {R('sh')} AS store_brand_share,
       {_share_flags_sql('sh', 'competitive')} FROM u"""))(
    lambda spark, d: finalize(st.store_share_in_brand(base(spark, d, sparse=True))))

PLATS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _w29_sql():
    cols = []
    for p in PLATS:
        n = p.lower()
        cols.append(f"CASE WHEN primary_platform = '{p}' THEN CAST(r AS INTEGER) ELSE 0 END AS {n}_sales_rank")
        cols.append(f"{I(f'primary_platform = {chr(39)}{p}{chr(39)} AND r <= 10')} AS {n}_top_10_store")
        cols.append(f"{I(f'primary_platform = {chr(39)}{p}{chr(39)} AND r <= 50')} AS {n}_top_50_store")
    return q(True, f"""
t AS (SELECT {ST}, sum(sales_quantity) AS tot FROM base GROUP BY ALL),
u AS (SELECT *, dense_rank() OVER (PARTITION BY primary_platform ORDER BY tot DESC) AS r FROM t)""",
             f"SELECT {ST}, {', '.join(cols)} FROM u")


register("w29_platform_ranks", _w29_sql())(
    lambda spark, d: finalize(st.platform_ranks(base(spark, d, sparse=True), PLATS)))


# ------------------------------------------------------------ A18 - A33 ------

register("a18_brand_presence", q(True, "t AS (SELECT 1)", f"""
SELECT brand_name, count(DISTINCT primary_platform) AS brand_platform_count,
       count(DISTINCT store_name) AS brand_total_stores, {R('sum(sales_quantity)')} AS brand_cross_platform_sales,
       {R(CENTS('sales_amount'))} AS brand_cross_platform_amount,
       {I('count(DISTINCT primary_platform) > 1')} AS brand_multi_platform,
       {I('count(DISTINCT primary_platform) = 1')} AS brand_platform_exclusive,
       {I('count(DISTINCT primary_platform) >= 3')} AS brand_omnichannel
FROM base GROUP BY brand_name"""))(lambda spark, d: finalize(pf.brand_presence(base(spark, d, sparse=True))))

register("a19_store_presence", q(True, "t AS (SELECT 1)", f"""
SELECT store_name, count(DISTINCT primary_platform) AS store_platform_count,
       count(DISTINCT brand_name) AS store_brand_count_cross, {R('sum(sales_quantity)')} AS store_cross_platform_sales,
       {I('count(DISTINCT primary_platform) > 1')} AS store_multi_platform_seller
FROM base GROUP BY store_name"""))(lambda spark, d: finalize(pf.store_presence(base(spark, d, sparse=True))))

register("a20_competing_platforms", q(True, "t AS (SELECT 1)", f"""
SELECT brand_name, store_name, count(DISTINCT primary_platform) AS competing_platforms,
       {I('count(DISTINCT primary_platform) > 1')} AS cross_platform_competition
FROM base GROUP BY 1, 2"""))(lambda spark, d: finalize(pf.competing_platforms(base(spark, d, sparse=True))))

register("a21_platform_preference", q(True, """
sp AS (SELECT store_name, primary_platform, sum(sales_quantity) AS tot,
              count(*) OVER (PARTITION BY store_name) AS np, max(sum(sales_quantity)) OVER (PARTITION BY store_name) AS mx
       FROM base GROUP BY 1, 2),
pref AS (SELECT store_name, arg_min(primary_platform, (-tot, primary_platform)) AS preferred_platform
         FROM sp WHERE np > 1 GROUP BY 1),
t AS (SELECT sp.*, preferred_platform, CASE WHEN np > 1 THEN tot / mx ELSE 1.0 END AS r
      FROM sp LEFT JOIN pref USING (store_name))""", f"""
SELECT store_name, primary_platform, preferred_platform,
       {I('primary_platform = preferred_platform')} AS on_preferred_platform, {R('r')} AS platform_performance_ratio,
       {I('r > 0.8')} AS platform_dominant_performance, {I('r >= 0.4 AND r <= 0.8')} AS platform_balanced_performance,
       {I('r < 0.4')} AS platform_weak_performance FROM t"""))(
    lambda spark, d: finalize(pf.platform_preference(base(spark, d, sparse=True))))

register("a24_platform_loyalty", q(True, """
t AS (SELECT store_name, brand_name, count(DISTINCT primary_platform) AS n,
             arg_min(primary_platform, (sales_month, primary_platform)) AS fp,
             arg_max(primary_platform, (sales_month, primary_platform)) AS lp FROM base GROUP BY 1, 2)""", f"""
SELECT store_name, brand_name, {I('n = 1')} AS platform_loyal, {I('n > 1')} AS platform_switcher,
       {I('fp = lp')} AS platform_stable FROM t"""))(
    lambda spark, d: finalize(pf.platform_loyalty(base(spark, d, sparse=True))))

@register("a25_platform_tenure", q(True, f"""
t AS (SELECT *, CAST(round(CAST(sales_month - min(sales_month) OVER (PARTITION BY {E}) AS INTEGER) / 30.44) AS INTEGER) AS ten
      FROM base),
qq AS (SELECT primary_platform, quantile_cont(ten, 0.25) AS q25, quantile_cont(ten, 0.75) AS q75 FROM t GROUP BY 1)""",
    f"""
SELECT {D('sales_month')} AS sales_month, {E}, product_code, ten AS platform_tenure_months,
       {I('ten <= 3')} AS platform_newcomer, {I('ten > 3 AND ten <= 12')} AS platform_experienced,
       {I('ten > 12')} AS platform_veteran, {I('ten >= q75')} AS platform_early_mover,
       {I('ten <= q25')} AS platform_late_entrant, {I('ten > q25 AND ten < q75')} AS platform_mid_entrant
FROM t JOIN qq USING (primary_platform)"""))
def a25_platform_tenure(spark, d):
    out = pf.entry_timing(pf.platform_tenure(base(spark, d, sparse=True)))
    return finalize(out.select("sales_month", "primary_platform", "store_name", "brand_name", "product_code",
                               "platform_tenure_months", "platform_newcomer", "platform_experienced",
                               "platform_veteran", "platform_early_mover", "platform_late_entrant",
                               "platform_mid_entrant"))


register("a26_platform_seasonal_index", q(True, """
pm AS (SELECT primary_platform, CAST(month(sales_month) AS INTEGER) AS month, avg(sales_quantity) AS m FROM base GROUP BY 1, 2),
pa AS (SELECT primary_platform, avg(sales_quantity) AS a FROM base GROUP BY 1)""", f"""
SELECT primary_platform, month, {R('m / a')} AS platform_seasonal_index, {I('m / a > 1.2')} AS platform_peak_season,
       {I('m / a >= 0.8 AND m / a <= 1.2')} AS platform_normal_season, {I('m / a < 0.8')} AS platform_low_season
FROM pm JOIN pa USING (primary_platform)"""))(
    lambda spark, d: finalize(pf.platform_seasonal_index(base(spark, d, sparse=True))))


def _promo_sql():
    from .q_core import _calendar_sql
    return _calendar_sql("SELECT DISTINCT sales_month AS d FROM base").replace(
        f"SELECT {D('d')} AS d, is_promotional_period,", "SELECT d, is_promotional_period,", 1)


@register("a27_platform_promo_lift", with_base_ctes(f"""
cal AS (WITH {_promo_sql()}),
j AS (SELECT b.primary_platform, b.sales_quantity, cal.is_promotional_period AS p
      FROM base b JOIN cal ON b.sales_month = cal.d),
t AS (SELECT primary_platform,
             coalesce(avg(CASE WHEN p = 1 THEN sales_quantity END) / avg(CASE WHEN p = 0 THEN sales_quantity END) - 1, 0) AS x
      FROM j GROUP BY 1)""", f"""
SELECT primary_platform, {R('x')} AS platform_promo_lift, {I('x > 0.5')} AS platform_promo_highly_responsive,
       {I('x > 0.2 AND x <= 0.5')} AS platform_promo_moderately_responsive,
       {I('x <= 0.2')} AS platform_promo_low_responsive FROM t""", True))
def a27_platform_promo_lift(spark, d):
    b = cal.add_calendar(base(spark, d, sparse=True), columns=["is_promotional_period"])
    return finalize(pf.platform_promo_lift(b))


register("a28_brand_platform_landscape", q(True, "t AS (SELECT 1)", f"""
SELECT brand_name, primary_platform, count(DISTINCT store_name) AS brand_platform_competitor_count,
       {R('sum(sales_quantity)')} AS brand_platform_total_sales,
       {R(CENTS('sales_amount'))} AS brand_platform_total_amount,
       {I('count(DISTINCT store_name) = 1')} AS brand_platform_monopoly,
       {I('count(DISTINCT store_name) >= 2 AND count(DISTINCT store_name) <= 5')} AS brand_platform_oligopoly,
       {I('count(DISTINCT store_name) > 5')} AS brand_platform_competitive
FROM base GROUP BY 1, 2"""))(lambda spark, d: finalize(pf.brand_platform_landscape(base(spark, d, sparse=True))))

register("a29_store_rank_in_brand_platform", q(True, """
t AS (SELECT brand_name, primary_platform, store_name, sum(sales_quantity) AS s FROM base GROUP BY ALL),
u AS (SELECT *, s / sum(s) OVER (PARTITION BY brand_name, primary_platform) AS sh,
             CAST(dense_rank() OVER (PARTITION BY brand_name, primary_platform ORDER BY s DESC) AS INTEGER) AS r FROM t)""",
    f"""
SELECT brand_name, primary_platform, store_name, {R('s')} AS store_bp_sales, {R('sh')} AS store_bp_market_share,
       r AS store_bp_rank, {I('r = 1')} AS store_bp_leader, {I('r <= 3')} AS store_bp_top_3,
       {I('r <= 10')} AS store_bp_top_10, {_share_flags_sql('sh', 'store_bp', ('dominant', 'major', 'minor', 'niche'))}
FROM u"""))(lambda spark, d: finalize(pf.store_rank_in_brand_platform(base(spark, d, sparse=True))))

register("a30_best_platform", q(True, """
sp AS (SELECT store_name, primary_platform, avg(sales_quantity) AS m FROM base GROUP BY 1, 2),
b AS (SELECT store_name, arg_min(primary_platform, (-m, primary_platform)) AS best_platform FROM sp GROUP BY 1)""", f"""
SELECT store_name, primary_platform, best_platform, {I('primary_platform = best_platform')} AS on_best_platform
FROM sp JOIN b USING (store_name)"""))(lambda spark, d: finalize(pf.best_platform(base(spark, d, sparse=True))))

register("a31_specialization", q(True, "t AS (SELECT 1)", f"""
SELECT store_name, {I('count(DISTINCT primary_platform) = 1')} AS store_specialization_strategy,
       {I('count(DISTINCT primary_platform) > 2')} AS store_diversification_strategy
FROM base GROUP BY 1"""))(lambda spark, d: finalize(pf.specialization(base(spark, d, sparse=True))))

register("a33_store_brand_strength", q(True, """
t AS (SELECT store_name, brand_name, count(DISTINCT sales_month) * avg(sales_quantity) AS s FROM base GROUP BY 1, 2)""",
    f"SELECT store_name, brand_name, {R('s / (max(s) OVER () + 1e-6)')} AS sb_relationship_score FROM t"))(
    lambda spark, d: finalize(ix.store_brand_strength(base(spark, d, sparse=True))))


# ------------------------------------------------------------ K, I -----------

@register("k2_seasonal_brand_top10", q(False, """
top AS (SELECT brand_name FROM base GROUP BY 1 ORDER BY count(*) DESC, brand_name LIMIT 10)""", f"""
SELECT brand_name, count(*) AS row_count, CAST(brand_name IN (SELECT brand_name FROM top) AS INTEGER) AS is_top10_brand
FROM base GROUP BY 1"""))
def k2_top_brands(spark, d):
    b = base(spark, d)
    top = [x for (x,) in ix.top_keys(b, ["brand_name"], 10)]
    return finalize(b.groupBy("brand_name").agg(F.count("*").alias("row_count"))
                    .withColumn("is_top10_brand", F.col("brand_name").isin(top).cast("int")))


@register("k3_platform_brand_top15", q(False, """
top AS (SELECT primary_platform, brand_name FROM base GROUP BY 1, 2
        ORDER BY count(*) DESC, primary_platform, brand_name LIMIT 15)""", """
SELECT primary_platform, brand_name, count(*) AS row_count,
       CAST((primary_platform, brand_name) IN (SELECT (primary_platform, brand_name) FROM top) AS INTEGER) AS is_top15_pair
FROM base GROUP BY 1, 2"""))
def k3_top_pairs(spark, d):
    b = base(spark, d)
    pairs = ix.top_keys(b, ["primary_platform", "brand_name"], 15)
    cond = F.lit(False)
    for p, br in pairs:
        cond = cond | ((F.col("primary_platform") == p) & (F.col("brand_name") == br))
    return finalize(b.groupBy("primary_platform", "brand_name").agg(F.count("*").alias("row_count"))
                    .withColumn("is_top15_pair", cond.cast("int")))


def _i1_sql():
    cols = ", ".join(f"CAST(month(sales_month) AS INTEGER) * CAST(primary_platform = '{p}' AS INTEGER) "
                     f"AS month_{p.lower()}_interaction" for p in PLATS)
    return q(False, "t AS (SELECT 1)", f"SELECT {D('sales_month')} AS sales_month, {E}, product_code, {cols} FROM base")


@register("i1_month_platform_interactions", _i1_sql())
def i1_interactions(spark, d):
    b = base(spark, d).withColumn("month", F.month("sales_month"))
    out = ix.platform_interactions(b, PLATS)
    return finalize(out.select("sales_month", *E.split(", "), "product_code",
                               *[f"month_{p.lower()}_interaction" for p in PLATS]))


# ------------------------------------------- X11, X12: whole reports; K2, K3: the columns ----

TYPE_FLAGS = [f"store_type_{t}" for t, _, _ in st.K.STORE_TYPE_KEYWORDS]
QUALITY_FLAGS = ["store_quality_high", "store_quality_medium", "store_quality_low"]
RETAILER_FLAGS = ["bm_multi_brand_retailer", "bm_high_volume_retailer", "bm_premium_retailer", "bm_budget_retailer"]


def _x11_sql():
    ctes = _n1_types_sql()[0] + f""",
c AS (SELECT {ST}, count(*) AS n, stddev_samp(sales_quantity) / (avg(sales_quantity) + 1) AS c,
             CAST(count(DISTINCT brand_name) * count(DISTINCT product_code) AS DOUBLE) AS dv,
             CAST(count(DISTINCT sales_month) AS DOUBLE) AS lg, sum(sales_quantity) AS vol,
             count(DISTINCT brand_name) AS b, avg(unit_price) AS pm FROM base GROUP BY ALL),
s1 AS (SELECT *, {_mm('c', True)} * 0.3 + {_mm('dv')} * 0.2 + {_mm('lg')} * 0.2 + {_mm('vol')} * 0.3 AS score
       FROM (SELECT * FROM c) AS t),
qq AS (SELECT quantile_cont(score, 0.33) AS q33, quantile_cont(score, 0.67) AS q67, quantile_cont(vol, 0.8) AS v80,
              quantile_cont(pm, 0.2) AS p20, quantile_cont(pm, 0.8) AS p80 FROM s1),
f AS (SELECT primary_platform, n, store_type, score, vol, b, pm, qq.* FROM s1 JOIN ty USING (store_name), qq)"""
    conds = [("store_type", f, f"store_type = '{f.removeprefix('store_type_')}'") for f in TYPE_FLAGS]
    conds += zip(["store_quality"] * 3, QUALITY_FLAGS, ["score > q67", "score > q33 AND score <= q67", "score <= q33"])
    conds += zip(["business_model"] * 4, RETAILER_FLAGS, ["b >= 5", "vol > v80", "pm > p80", "pm < p20"])
    return q(True, ctes, "\nUNION ALL\n".join(
        f"SELECT coalesce(primary_platform, 'all') AS primary_platform, '{g}' AS flag_group, '{f}' AS flag, "
        f"CAST(coalesce(sum(CASE WHEN {c} THEN n END), 0) AS BIGINT) AS total FROM f GROUP BY ROLLUP (primary_platform)"
        for g, f, c in conds))


@register("x11_store_flag_totals", _x11_sql())
def x11_flag_totals(spark, d):
    """X11: rows by store type, quality tier and business model, by platform and over all."""
    b = base(spark, d, sparse=True)
    return finalize(ex.store_flag_totals(b, {"store_type": st.store_types(b).select("store_name", *TYPE_FLAGS),
                                             "store_quality": st.store_quality(b).select(*st.STORE, *QUALITY_FLAGS),
                                             "business_model": st.business_model(b).select(*st.STORE, *RETAILER_FLAGS)}))


@register("x12_platform_landscape", q(True, "t AS (SELECT sum(sales_quantity) AS total FROM base)", f"""
SELECT primary_platform, {R('sum(sales_quantity)')} AS quantity,
       {R('floor(sum(sales_quantity) * 100 / any_value(total) * 100 + 0.5) / 100')} AS share_pct,
       count(DISTINCT store_name) AS stores, count(DISTINCT brand_name) AS brands FROM base, t GROUP BY 1"""))
def x12_platforms(spark, d):
    """Share of all quantity, stores and brands of each platform."""
    return finalize(ex.platform_landscape(base(spark, d, sparse=True)))


@register("x12_brand_reach", q(True, """
m AS (SELECT brand_name, primary_platform, sum(sales_quantity) AS q FROM base GROUP BY ALL),
r AS (SELECT brand_name, count(*) FILTER (WHERE q > 0) AS np FROM m GROUP BY 1)""", """
SELECT count(*) FILTER (WHERE np = 1) AS single_platform, count(*) FILTER (WHERE np = 2) AS dual_platform,
       count(*) FILTER (WHERE np >= 3) AS multi_platform FROM r"""))
def x12_reach(spark, d):
    """Brands sold on one, two, and three or more platforms."""
    return finalize(ex.brand_reach(base(spark, d, sparse=True)))


def _monthly_totals(df, prefix):
    """Each prefixed column's total by month, as rows."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    return (df.groupBy("sales_month").agg(*[F.sum(c).cast("long").alias(c) for c in cols])
            .unpivot(["sales_month"], cols, "feature", "total"))


def _label_sql(c):
    return f"replace(replace(replace(lower({c}), ' ', '_'), '(', ''), ')', '')"


@register("k2_seasonal_brand_columns", q(False, """
top AS (SELECT brand_name AS tb FROM base GROUP BY 1 ORDER BY count(*) DESC, brand_name LIMIT 10)""", f"""
SELECT {D('sales_month')} AS sales_month, 'seasonal_brand_' || {_label_sql('tb')} AS feature,
       CAST(sum(CASE WHEN brand_name = tb THEN month(sales_month) ELSE 0 END) AS BIGINT) AS total FROM base, top GROUP BY 1, 2"""))
def k2_columns(spark, d):
    """K2: the seasonal_brand_* columns of all rows, added up by month."""
    return finalize(_monthly_totals(ix.seasonal_brand(base(spark, d)), "seasonal_brand_"))


@register("k3_platform_brand_columns", q(False, """
top AS (SELECT primary_platform AS tp, brand_name AS tb FROM base GROUP BY 1, 2
        ORDER BY count(*) DESC, primary_platform, brand_name LIMIT 15)""", f"""
SELECT {D('sales_month')} AS sales_month,
       'platform_brand_' || replace(lower(tp), ' ', '_') || '_' || {_label_sql('tb')} AS feature,
       CAST(sum(CASE WHEN brand_name = tb AND primary_platform = tp THEN 1 ELSE 0 END) AS BIGINT) AS total
FROM base, top GROUP BY 1, 2"""))
def k3_columns(spark, d):
    """K3: the platform_brand_* flags of all rows, added up by month."""
    return finalize(_monthly_totals(ix.platform_brand_flags(base(spark, d)), "platform_brand_"))

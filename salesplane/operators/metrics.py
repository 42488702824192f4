"""Forecast-error metrics and reports (E1-E25) over a predictions table
(keys, y_true, y_pred).  All are aggregates; no rows reach the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip, flag

# --- FIXED VALUES: error category bounds and labels -------------------------
ERROR_CATEGORIES = [(5, "Excellent (<5%)"), (10, "Very Good (5-10%)"), (20, "Good (10-20%)"),
                    (50, "Fair (20-50%)")]
ERROR_CATEGORY_ELSE = "Poor (>50%)"


def row_errors(df: DataFrame, y="y_true", p="y_pred") -> DataFrame:
    """E1 + E2."""
    ae = F.abs(F.col(p) - F.col(y))
    pe = ae / (F.col(y) + 1.0) * 100
    cat = F.lit(ERROR_CATEGORY_ELSE)
    for bound, label in reversed(ERROR_CATEGORIES):
        cat = F.when(pe < bound, F.lit(label)).otherwise(cat)
    return df.select("*", ae.alias("absolute_error"), pe.alias("percentage_error"),
                     flag(ae < 1).alias("is_perfect"), cat.alias("error_category"))


def masked_mape(y: Column, p: Column, eps=1e-8) -> Column:
    """Mean |e/y| over |y| > eps, 100 when no row qualifies."""
    m = F.avg(F.when(F.abs(y) > eps, F.abs((y - p) / y)))
    return F.coalesce(m * 100, F.lit(100.0))


def safe_mape_log(y: Column, p: Column) -> Column:
    """E5: log-scale inputs, expm1, clip [.1, 1e6], /(y+1), capped at 1000."""
    yt, yp = clip(F.expm1(y), 0.1, 1e6), clip(F.expm1(p), 0.1, 1e6)
    return F.least(F.avg(F.abs(yt - yp) / (yt + 1.0)) * 100, F.lit(1000.0))


def enhanced_mape(y: Column, p: Column, hi=1e6) -> Column:
    """Clip [.1, hi], eps = max(1, .01 y), capped at 500."""
    yt, yp = clip(y, 0.1, hi), clip(p, 0.1, hi)
    return F.least(F.avg(F.abs(yt - yp) / F.greatest(F.lit(1.0), 0.01 * yt)) * 100, F.lit(500.0))


def evaluator_mape(y: Column, p: Column) -> Column:
    """Clip [1, 1e6], /(y+1), no cap."""
    yt, yp = clip(y, 1, 1e6), clip(p, 1, 1e6)
    return F.avg(F.abs(yt - yp) / (yt + 1)) * 100


def floored_mape(y: Column, p: Column) -> Column:
    """Both floored at 1, sklearn MAPE."""
    yt, yp = F.greatest(y, F.lit(1.0)), F.greatest(p, F.lit(1.0))
    return F.avg(F.abs(yt - yp) / yt) * 100


def naive_mape(y: Column, p: Column) -> Column:
    """E10."""
    e = F.abs(y - p)
    ratio = F.when(y == 0, F.when(e == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))).otherwise(e / F.abs(y))
    return F.avg(ratio) * 100


def metric_aggs(y="y_true", p="y_pred") -> list:
    """E3, E4, E5, E7, E9, E10 as one list of aggregate expressions.

    R2 = 1 - SSE/SST with SST = sum(y^2) - n*mean^2 computed from moments in
    the same pass (no second pass over the data).
    """
    yc, pc = F.col(y), F.col(p)
    n = F.count(yc)
    sse = F.sum((yc - pc) * (yc - pc))
    sst = F.var_pop(yc) * n
    return [n.alias("n"), masked_mape(yc, pc).alias("mape"), F.avg(F.abs(yc - pc)).alias("mae"),
            F.sqrt(F.avg((yc - pc) * (yc - pc))).alias("rmse"), (1 - F.try_divide(sse, sst)).alias("r2"),
            evaluator_mape(yc, pc).alias("evaluator_mape"), floored_mape(yc, pc).alias("floored_mape"),
            naive_mape(yc, pc).alias("naive_mape"),
            safe_mape_log(F.log1p(yc), F.log1p(pc)).alias("safe_mape_log")]


def metrics_by(df: DataFrame, keys, y="y_true", p="y_pred") -> DataFrame:
    """Metrics per key group (split, platform, month, brand, store ...)."""
    return df.groupBy(*keys).agg(*metric_aggs(y, p))


def platform_over_splits(df: DataFrame, y="y_true", p="y_pred", key="primary_platform") -> DataFrame:
    """Safe MAPE of each (split, platform), then its mean, std (ddof 0), least, greatest
    value and number of splits by platform."""
    per = df.groupBy("split_id", key).agg(safe_mape_log(F.log1p(y), F.log1p(p)).alias("_m"))
    m = F.col("_m")
    return per.groupBy(key).agg(F.avg(m).alias("mean_mape"), F.stddev_pop(m).alias("std_mape"), F.min(m).alias("min_mape"),
                                F.max(m).alias("max_mape"), F.count(m).alias("splits_analyzed"))


def baseline_summary(baselines: DataFrame, cols, model_mape: float) -> DataFrame:
    """Best baseline under 1000 (null if none), the model's improvement factor over
    it (0 for a model MAPE of 0 or less) and the assessment."""
    best = F.array_min(F.array_compact(F.array(*[F.when(F.col(c) < 1000, F.col(c)) for c in cols])))
    factor = best / model_mape if model_mape > 0 else F.lit(0.0)
    return baselines.select("*", best.alias("best_baseline_mape"), factor.alias("improvement_factor"),
                            F.lit("Outstanding" if model_mape < 10 else "Excellent").alias("business_assessment"))


def monitored_metrics(y: Column, p: Column):
    """Training-monitor MAPE and RMSE on log inputs: expm1, clip [1, 1e6];
    errors are divided by y + 1 and the mean, not the rows, is clipped to [0, 1000]."""
    yt, yp = clip(F.expm1(y), 1, 1e6), clip(F.expm1(p), 1, 1e6)
    mape = clip(F.avg(F.abs(yt - yp) / (yt + 1.0)) * 100, 0, 1000)
    return mape.alias("monitored_mape"), F.sqrt(F.avg((yt - yp) * (yt - yp))).alias("monitored_rmse")


def across_splits(per_split: DataFrame, cols=("mape", "rmse", "r2")) -> DataFrame:
    """Mean / std (ddof 0) / min / max across splits (temporal performance)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return per_split.agg(*aggs)


# --- FIXED VALUES: grade bounds, whether a bound belongs to the better grade,
# and labels, by rule set ------------------------------------------------------
GRADE_RULES = {
    "trainer": ((15, 20, 30), True, ("EXCELLENT", "GOOD", "FAIR", "POOR")),
    "phase3": ((10, 20, 30), True, ("EXCELLENT", "GOOD", "FAIR", "POOR")),
    "fixed": ((15, 25, 40), False, ("EXCELLENT", "GOOD", "MODERATE", "POOR")),
    "notebook": ((5, 10, 20), True, ("EXCELLENT", "USABLE", "BARELY USABLE", "POOR")),
}
CONSISTENT_STD = 3


def grade(mape: Column, rules: str = "trainer") -> Column:
    """E12."""
    bounds, inclusive, labels = GRADE_RULES[rules]
    out = F.lit(labels[-1])
    for bound, label in reversed(list(zip(bounds, labels))):
        out = F.when(mape <= bound if inclusive else mape < bound, F.lit(label)).otherwise(out)
    return out


def consistency_grade(std: Column) -> Column:
    """Spread of the MAPE across splits."""
    return F.when(std <= CONSISTENT_STD, "CONSISTENT").otherwise("INCONSISTENT")


def prediction_distribution(df: DataFrame, p="y_pred") -> DataFrame:
    """Near-zero, extreme, negative counts and range."""
    x = F.col(p)
    return df.agg(F.count_if(x < 1).alias("near_zero"), F.count_if(x > 100000).alias("extreme"),
                  F.count_if(x < 0).alias("negative"), F.min(x).alias("pred_min"), F.max(x).alias("pred_max"))


def health_rules(mape: Column, std: Column) -> list[Column]:
    """MAPE level and spread across splits, judged independently."""
    level = (F.when(mape > 50, "very_high").when(mape > 30, "high").when(mape < 10, "suspiciously_low")
             .otherwise("reasonable"))
    return [level.alias("mape_health"), F.when(std > 5, "high_variance").otherwise("consistent").alias("std_health")]


def degradation(mape: Column, baseline: float) -> Column:
    """Points above a baseline MAPE; over 2 alert, over 1 warning."""
    d = mape - baseline
    return F.when(d > 2.0, "alert").when(d > 1.0, "warning").otherwise("stable")


# --- FIXED VALUES: sanity and readiness thresholds ---------------------------
SANITY = {"avg_mape_low": 5, "std_low": 2, "avg_mape_mid": 15, "perfect_share": 0.10}


def sanity_flags(summary: DataFrame) -> DataFrame:
    """Suspicious-result rules over an across-splits summary (needs mape_mean, mape_std)
    and, when present, the share of perfect predictions."""
    m, s = F.col("mape_mean"), F.col("mape_std")
    cols = [flag(m < SANITY["avg_mape_low"]).alias("suspiciously_low_mape"),
            flag((s < SANITY["std_low"]) & (m < SANITY["avg_mape_mid"])).alias("suspiciously_stable")]
    if "perfect_share" in summary.columns:
        cols.append(flag(F.col("perfect_share") > SANITY["perfect_share"]).alias("too_many_perfect"))
    return summary.select("*", *cols)


def business_ready(summary: DataFrame, expected_mape: float, notebook_mape: float | None = None) -> DataFrame:
    """MAPE within expectation, std <= 5, business readiness (MAPE <= 20 and std <= 5)
    and, against a reference run, worse (over 5 points), better (over 2 points) or
    comparable; only worse fails the validation."""
    m, s = F.col("mape_mean"), F.col("mape_std")
    passed = (m <= expected_mape) & (s <= 5)
    cols = [flag(m <= expected_mape).alias("meets_expected"), flag(s <= 5).alias("consistent"),
            flag((m <= 20) & (s <= 5)).alias("business_ready")]
    if notebook_mape is not None:
        d = m - notebook_mape
        passed = passed & (d <= 5)
        cols.append(F.when(d > 5, "worse").when(d < -2, "better").otherwise("comparable").alias("against_reference"))
    return summary.select("*", *cols, flag(passed).alias("validation_passed"))


def compare_models(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> DataFrame:
    """Per split MAPE of two models, improvement in points and the winner."""
    j = a.select("split_id", F.col("mape").alias(f"mape_{name_a}")).join(
        b.select("split_id", F.col("mape").alias(f"mape_{name_b}")), "split_id")
    imp = F.col(f"mape_{name_a}") - F.col(f"mape_{name_b}")
    return j.select("*", imp.alias("improvement_points"),
                    F.when(imp > 0, F.lit(name_b)).when(imp < 0, F.lit(name_a)).otherwise("tie").alias("winner"))


MAX_EPOCHS = 100


def training_efficiency(run_log: DataFrame) -> DataFrame:
    """Over a run log (split_id, epochs_trained, best_epoch): mean epochs, mean best
    epoch, share of runs stopped before MAX_EPOCHS, relative spread of the best epoch."""
    return run_log.agg(F.avg("epochs_trained").alias("average_epochs_used"), F.avg("best_epoch").alias("average_best_epoch"),
                       F.avg((F.col("epochs_trained") < MAX_EPOCHS).cast("double")).alias("early_stopping_rate"),
                       F.try_divide(F.stddev_pop("best_epoch"), F.avg("best_epoch")).alias("training_stability"))


def recommendations(summary: DataFrame) -> DataFrame:
    """Array of recommendations from mape_mean, mape_std and, where present,
    early_stopping_rate and platform_spread (largest minus smallest platform MAPE)."""
    m, s = F.col("mape_mean"), F.col("mape_std")
    rules = [(m <= 15, "ready_for_production"), ((m > 15) & (m <= 20), "suitable_for_business_use"),
             (m > 20, "needs_improvement"), (s > CONSISTENT_STD, "check_overfitting")]
    if "early_stopping_rate" in summary.columns:
        r = F.col("early_stopping_rate")
        rules += [(r > 0.8, "fewer_epochs"), (r < 0.2, "more_epochs")]
    if "platform_spread" in summary.columns:
        rules.append((F.col("platform_spread") > 10, "tune_by_platform"))
    found = F.array_compact(F.array(*[F.when(c, F.lit(x)) for c, x in rules]))
    return summary.select("*", found.alias("recommendations"))


def performance_table(per_split: DataFrame, rules: str = "trainer") -> DataFrame:
    """One row per split with its grade."""
    return per_split.select("*", grade(F.col("mape"), rules).alias("grade")).orderBy("split_id")

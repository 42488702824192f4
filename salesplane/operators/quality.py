"""Data-quality profiles (Q1-Q11, U3): one wide aggregate pass, then a
long-form (column, metric) table via ``unpivot`` so the width stays a row count."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import safe_corr
from .clean import numeric_columns


def numeric_profile(df: DataFrame, cols=None) -> DataFrame:
    """Q1/Q8: per numeric column: nulls, zeros, negatives, infinities, min, max, mean, std."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count_if(x.isNull()).cast("double").alias(f"{c}|nulls"),
                 F.count_if(x == 0).cast("double").alias(f"{c}|zeros"),
                 F.count_if(x < 0).cast("double").alias(f"{c}|negatives"),
                 F.count_if(F.abs(x) == float("inf")).cast("double").alias(f"{c}|infinite"),
                 F.min(x).alias(f"{c}|min"), F.max(x).alias(f"{c}|max"), F.avg(x).alias(f"{c}|mean"),
                 F.stddev_samp(x).alias(f"{c}|std")]
    wide = df.agg(*aggs)
    long = wide.unpivot([], [F.col(f"`{a}`") for a in wide.columns], "key", "value")
    return long.select(F.split("key", r"\|")[0].alias("column_name"), F.split("key", r"\|")[1].alias("metric"), "value")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows."""
    g = df.groupBy(*df.columns).count()
    return g.agg(F.sum("count").alias("rows"), F.count("*").alias("distinct_rows"),
                 F.sum(F.col("count") - 1).alias("duplicate_rows"))


def dataset_checks(df: DataFrame, date_col: str = "sales_month") -> DataFrame:
    """Q2: overall counts, coverage and issue flags in one row."""
    q = F.col("sales_quantity")
    return df.agg(F.count("*").alias("rows"), F.count_distinct("primary_platform").alias("platforms"),
                  F.count_distinct(date_col).alias("months"), F.min(date_col).alias("date_min"),
                  F.max(date_col).alias("date_max"), F.avg(q).alias("mean_quantity"),
                  F.sum(F.round(F.col("sales_amount") * 100).cast("long")).alias("total_amount_cents"),
                  F.count_if(q < 0).alias("negative_rows"), F.count_if(q == 0).alias("zero_rows")
                  ).withColumn("issue_negative", (F.col("negative_rows") > 0).cast("int")
                  ).withColumn("issue_many_zeros", (F.col("zero_rows") > 0.1 * F.col("rows")).cast("int"))


def required_columns(df: DataFrame, required) -> list:
    """Q6/Q9: missing required columns (schema only)."""
    return [c for c in required if c not in df.columns]


def is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def validate_features(df: DataFrame, features, target: str = "sales_quantity_log") -> DataFrame:
    """Q3: per feature null ratio, infinities, zero variance, bias-corrected skew and
    |corr| with the target, from one aggregate pass; flags follow the source rules
    (null ratio > .1, |skew| > 3, |corr target| < .01)."""
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x.isNull().cast("double")).alias(f"{c}|null_ratio"),
                 F.count_if(F.abs(x) == float("inf")).cast("double").alias(f"{c}|infinite"),
                 F.stddev_pop(x).alias(f"{c}|std"), F.skewness(x).alias(f"{c}|skew_pop"),
                 F.count(x).cast("double").alias(f"{c}|n"), safe_corr(x, target).alias(f"{c}|corr_target")]
    wide = df.agg(*aggs)
    long = wide.unpivot([], [F.col(f"`{a}`") for a in wide.columns], "key", "value")
    long = long.select(F.split("key", r"\|")[0].alias("feature"), F.split("key", r"\|")[1].alias("metric"), "value")
    t = long.groupBy("feature").pivot("metric", ["null_ratio", "infinite", "std", "skew_pop", "n", "corr_target"]).agg(
        F.first("value"))
    n = F.col("n")
    skew = F.when(n > 2, F.col("skew_pop") * F.sqrt(n * (n - 1)) / (n - 2))
    return t.select("feature", "null_ratio", "infinite", skew.alias("skewness"),
                    F.abs("corr_target").alias("abs_corr_target"),
                    (F.coalesce(F.col("std"), F.lit(0.0)) == 0).cast("int").alias("zero_variance"),
                    (F.col("null_ratio") > 0.1).cast("int").alias("high_null"),
                    F.coalesce(F.abs(skew) > 3, F.lit(False)).cast("int").alias("high_skew"),
                    F.coalesce(F.abs("corr_target") < 0.01, F.lit(False)).cast("int").alias("weak_target"))


def temporal_integrity(df: DataFrame, entity=("primary_platform", "store_name", "brand_name"),
                       date_col: str = "sales_month", max_gap_days: int = 62, order_col: str | None = None) -> DataFrame:
    """Q5: per entity, gaps between dates, longest gap and months covered; with
    ``order_col`` (the order the rows were stored in; a table has none of its own)
    also the rows whose date precedes that of the row before."""
    ws = Window.partitionBy(*entity).orderBy(date_col)
    d = df.withColumn("_gap", F.datediff(F.col(date_col), F.lag(date_col).over(ws)))
    aggs = [F.count_if(F.col("_gap") > max_gap_days).alias("gap_count"), F.max("_gap").alias("max_gap_days"),
            F.round(F.datediff(F.max(date_col), F.min(date_col)) / 30.44).alias("months_covered")]
    if order_col:
        w = Window.partitionBy(*entity).orderBy(order_col)
        d = d.withColumn("_back", F.col(date_col) < F.lag(date_col).over(w))
        aggs.insert(0, F.count_if("_back").alias("out_of_order_rows"))
    return d.groupBy(*entity).agg(*aggs)


def summary_table(df: DataFrame, cols=None) -> DataFrame:
    """Q7: count / mean / stddev / min / quartiles / max per numeric column (built-in summary)."""
    cols = cols or numeric_columns(df)
    return df.select(*cols).summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def training_input_checks(df: DataFrame, features, target: str = "sales_quantity_log") -> DataFrame:
    """Q9/Q10: rows, target spread, and per-feature missing share / non-finite counts (one row per feature)."""
    aggs = [F.count("*").alias("rows"), F.stddev_pop(target).alias("target_std")]
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x.isNull().cast("double")).alias(f"{c}|missing"),
                 F.count_if(F.isnan(x) | (F.abs(x) == float("inf"))).cast("double").alias(f"{c}|non_finite")]
    wide = df.agg(*aggs)
    long = wide.unpivot(["rows", "target_std"], [F.col(f"`{c}|{m}`") for c in features for m in ("missing", "non_finite")],
                        "key", "value")
    out = long.select("rows", "target_std", F.split("key", r"\|")[0].alias("feature"),
                      F.split("key", r"\|")[1].alias("metric"), "value")
    return out.withColumn("fails", ((F.col("metric") == "missing") & (F.col("value") > 0.1)
                                    | (F.col("rows") == 0) | (F.coalesce(F.col("target_std"), F.lit(0.0)) == 0)).cast("int"))


def high_outliers(df: DataFrame, column: str = "sales_quantity", q: float = 0.99) -> DataFrame:
    """Q11: rows above the column's q-quantile (count and share)."""
    from ..functions.stats import quantile
    thr = quantile(df, column, q)
    x = F.col(column)
    return df.agg(F.lit(thr).alias("threshold"), F.count_if(x > thr).alias("outliers"),
                  F.avg((x > thr).cast("double")).alias("outlier_share"))


def value_counts(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, value, n) of every value of every column, as text; null is a value.

    One pass and one shuffle whatever the number of columns: rows are unpivoted and
    counted by (column, value) with map-side sums, so a frequent value is one row a task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols or df.columns])
    return df.select(F.explode(pairs).alias("_v")).groupBy("_v.column_name", "_v.value").agg(F.count("*").alias("n"))


def level_report(counts: DataFrame, max_levels: int = 20, first: int = 5) -> DataFrame:
    """X13, a row for each column of ``value_counts``: distinct non-null values, nulls, the
    ``first`` least values, and the levels with their counts where there are at most
    ``max_levels`` (null otherwise).  Values are in text order, a table having no first row.
    """
    known = F.col("value").isNotNull()
    per = counts.groupBy("column_name").agg(F.count_if(known).alias("unique_count"),
                                            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"))
    few = per.where(F.col("unique_count") <= max_levels).select(F.col("column_name").alias("_few"))  # a row a column at most
    levels = counts.where(known).join(F.broadcast(few), F.col("column_name") == F.col("_few"), "left_semi").groupBy("column_name").agg(
        F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "value", "n"))), ", ").alias("levels"))
    # The least values of 64 parts of a column, then the least of those.
    salt = F.pmod(F.xxhash64("value"), F.lit(64))
    w = Window.partitionBy("column_name", salt).orderBy("value")
    least = counts.where(known).select("column_name", "value", F.row_number().over(w).alias("_r")).where(F.col("_r") <= first)
    firsts = least.groupBy("column_name").agg(F.array_join(F.slice(F.sort_array(F.collect_list("value")), 1, first), ", ").alias("first_values"))
    return per.join(firsts, "column_name", "left").join(levels, "column_name", "left")


def integrity_report(df: DataFrame, max_levels: int = 20) -> DataFrame:
    """Q1 whole: (column_name, metric, value, text).

    Column ``*``: rows, columns, total_missing, duplicate_rows, and the number of numeric,
    date and categorical columns.  Every column: missing, missing_percent, type (text).
    Numeric ones: zeros, negatives, infinite.  Dates: first and last day (text).
    Categorical ones: unique_count and, up to ``max_levels``, one ``level`` row for each
    value (text) with its count.  An empty table has null percentages.
    """
    kinds = {f.name: "numeric" if isinstance(f.dataType, T.NumericType) else "date" if isinstance(f.dataType, (T.DateType, T.TimestampType))
             else "categorical" if isinstance(f.dataType, T.StringType) else "other" for f in df.schema.fields}
    aggs, none = [F.count("*").cast("double").alias("*|rows")], F.lit(None).cast("string")
    for c, kind in kinds.items():
        x = F.col(f"`{c}`")
        aggs.append(F.count_if(x.isNull()).cast("double").alias(f"{c}|missing"))
        if kind == "numeric":
            v = x.cast("double")
            aggs += [F.count_if(v == 0).cast("double").alias(f"{c}|zeros"), F.count_if(v < 0).cast("double").alias(f"{c}|negatives"),
                     F.count_if(F.abs(v) == float("inf")).cast("double").alias(f"{c}|infinite")]
        elif kind == "date":
            aggs += [F.unix_date(F.min(x).cast("date")).cast("double").alias(f"{c}|first_day"),
                     F.unix_date(F.max(x).cast("date")).cast("double").alias(f"{c}|last_day")]
    row = df.agg(*aggs).first().asDict()  # a few numbers for each column
    rows, out = row["*|rows"], []
    missing = {c: row[f"{c}|missing"] for c in kinds}
    out += [("*", "rows", rows, None), ("*", "columns", float(len(kinds)), None), ("*", "total_missing", sum(missing.values()), None)]
    out += [("*", f"{k}_columns", float(sum(v == k for v in kinds.values())), None) for k in ("numeric", "date", "categorical")]
    for c, kind in kinds.items():
        out += [(c, "missing", missing[c], None), (c, "missing_percent", missing[c] / rows * 100 if rows else None, None), (c, "type", None, kind)]
        for m in ("zeros", "negatives", "infinite"):
            if kind == "numeric":
                out.append((c, m, row[f"{c}|{m}"], None))
        for m in ("first_day", "last_day"):
            if kind == "date":
                day = row[f"{c}|{m}"]
                out.append((c, m, None, None if day is None else str(date(1970, 1, 1) + timedelta(days=int(day)))))
    report = df.sparkSession.createDataFrame(out, "column_name string, metric string, value double, text string")
    same = duplicate_rows(df).select(F.lit("*").alias("column_name"), F.lit("duplicate_rows").alias("metric"),
                                     F.coalesce("duplicate_rows", F.lit(0)).cast("double").alias("value"), none.alias("text"))
    report = report.unionByName(same)
    text_cols = [c for c, k in kinds.items() if k == "categorical"]
    if not text_cols:
        return report
    counts = value_counts(df, text_cols).where("value IS NOT NULL")
    unique = counts.groupBy("column_name").agg(F.count("*").cast("double").alias("value"))
    few = unique.where(F.col("value") <= max_levels).select("column_name")
    levels = counts.join(F.broadcast(few), "column_name", "left_semi").select(
        "column_name", F.lit("level").alias("metric"), F.col("n").cast("double").alias("value"), F.col("value").alias("text"))
    return report.unionByName(unique.select("column_name", F.lit("unique_count").alias("metric"), "value", none.alias("text"))).unionByName(levels)


def training_issues(df: DataFrame, features, windows, target: str = "sales_quantity_log",
                    required=("sales_month", "store_name", "brand_name", "primary_platform"), date_col: str = "sales_month") -> dict:
    """Q9: {"issues": [...], "passed": bool} before training.  Fails for missing required
    columns, over a tenth of the features missing, no windows, a window without training or
    validation rows, and a target without spread; fewer missing features are only named."""
    issues, passed = [], True
    lacking = [c for c in (*required, target) if c not in df.columns]
    if lacking:
        issues, passed = [f"missing required columns: {', '.join(lacking)}"], False
    gone = [f for f in features if f not in df.columns]
    if gone:
        issues.append(f"{len(gone)} of {len(features)} features missing: {', '.join(gone)}")
        passed = passed and len(gone) <= 0.1 * len(features)
    if not windows:
        issues, passed = [*issues, "no splits"], False
    if windows and date_col in df.columns:
        d = F.col(date_col)
        row = df.agg(*[F.count_if((d >= F.lit(lo)) & (d < F.lit(hi))).alias(f"{k}_{role}") for k, ts, te, vs, ve, _ in windows
                       for role, lo, hi in (("train", ts, te), ("val", vs, ve))]).first()
        for k, *_ in windows:
            empty = [role for role in ("train", "val") if not row[f"{k}_{role}"]]
            if empty:
                issues, passed = [*issues, f"split {k} has no {' and no '.join(empty)} rows"], False
    if target in df.columns and not (df.agg(F.stddev_pop(target)).first()[0] or 0.0) > 0:
        issues, passed = [*issues, "target has no spread"], False
    return {"issues": issues, "passed": passed}


def prepared_input_checks(df: DataFrame, inputs) -> DataFrame:
    """Q10, a row for each input column: present values, NaN (nulls too), infinite, min, max,
    mean and population std of the finite ones, and ``fails`` (NaN, infinite or nothing present)."""
    rows = F.array(*[F.struct(F.lit(c).alias("input"), F.col(f"`{c}`").cast("double").alias("x")) for c in inputs])
    x = F.col("x")
    bad, inf = x.isNull() | F.isnan(x), F.abs(x) == float("inf")
    y = F.when(~bad & ~inf, x)
    out = df.select(F.explode(rows).alias("_v")).select("_v.*").groupBy("input").agg(
        F.count(y).alias("present"), F.count_if(bad).alias("nan"), F.count_if(~F.isnan(x) & inf).alias("infinite"), F.min(y).alias("min"),
        F.max(y).alias("max"), F.avg(y).alias("mean"), F.stddev_pop(y).alias("std"))
    return out.withColumn("fails", ((F.col("nan") > 0) | (F.col("infinite") > 0) | (F.col("present") == 0)).cast("int"))

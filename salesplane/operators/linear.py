"""Ridge and elastic net of every expanding split from one pass over the fact.

A task adds up, for each date, the products of all column pairs; Spark sums them over
the tasks and then over the dates of each split's training window.  A split's fit
reads k x k sums, whatever the number of rows: ridge solves its normal equations,
elastic net descends one coordinate after the other.  Inputs are standardised with
the split's own training means and deviations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gram import _means
from .splits import in_windows

#: (model, penalty, share of it on absolute values).
MODELS = (("ridge", 1.0, 0.0), ("elastic_net", 1.0, 0.5))
#: Elastic net stops when no coefficient moved by more than this, or after SWEEPS.
TOLERANCE, SWEEPS = 1e-12, 10_000


def dated_products(df: DataFrame, cols, date_col: str, shifts) -> DataFrame:
    """(date_col, i, j, s): sums of products of columns i and j, each less its shift,
    over the rows of a date in which all of ``cols`` are finite.  Column 0 is the
    constant 1.  Rows without a date are left out."""
    k, base = len(cols) + 1, np.array(shifts)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = pdf.drop(columns="day").to_numpy(dtype=np.float64, na_value=np.nan) - base
            whole = np.isfinite(x).all(axis=1)
            x, days = np.column_stack([np.ones(whole.sum()), x[whole]]), pdf["day"].to_numpy()[whole]
            for day in np.unique(days):
                part = x[days == day]
                sums[day] = sums.get(day, 0.0) + part.T @ part
        for day, s in sums.items():
            yield pd.DataFrame({"day": np.full(k, day, np.int32), "i": np.arange(k, dtype=np.int32), "row": list(s)})

    rows = df.where(F.col(date_col).isNotNull()).select(
        F.unix_date(F.col(date_col).cast("date")).alias("day"), *[F.col(c).cast("double").alias(f"c{n}") for n, c in enumerate(cols)])
    return (rows.mapInPandas(partial, "day int, i int, row array<double>").select("day", "i", F.posexplode("row").alias("j", "s"))
            .groupBy("day", "i", "j").agg(F.sum("s").alias("s")).select(F.date_from_unix_date("day").alias(date_col), "i", "j", "s"))


def ridge(c: np.ndarray, cy: np.ndarray, n: float, alpha: float) -> np.ndarray:
    """Least |y - Xw|^2 + alpha |w|^2 for standardised X with covariance ``c``."""
    return np.linalg.solve(n * c + alpha * np.eye(len(cy)), n * cy)


def elastic_net(c: np.ndarray, cy: np.ndarray, alpha: float, l1_ratio: float) -> np.ndarray:
    """Least |y - Xw|^2 / 2n + alpha (l1_ratio |w|_1 + (1 - l1_ratio) |w|^2 / 2), by coordinate descent."""
    w, l1, l2 = np.zeros(len(cy)), alpha * l1_ratio, alpha * (1 - l1_ratio)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(w)):
            rest = cy[j] - c[j] @ w + c[j, j] * w[j]
            size = c[j, j] + l2
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / size if size > 0 else 0.0
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= TOLERANCE:
            break
    return w


def fit_splits(df: DataFrame, windows, features, label: str, date_col: str = "sales_month", models=MODELS, shifts=None) -> list[dict]:
    """One dict for each split and model: split_id, model, train_rows, intercept (the
    training mean of the label), means, stds and coefficients (of standardised
    inputs) by feature.  Training rows are those with finite features and label; a
    split without any is left out.  A constant feature has std 1 and coefficient 0.
    ``shifts``: numbers near the means of features and label, by default the means."""
    if not windows:
        return []
    cols = [*features, label]
    shifts = _means(df, cols) if shifts is None else list(shifts)
    sums = in_windows(dated_products(df, cols, date_col, shifts), windows, "train", date_col)
    k, found = len(cols) + 1, {}
    for r in sums.groupBy("split_id", "i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        found.setdefault(r["split_id"], np.zeros((k, k)))[r["i"], r["j"]] = r["s"]
    out = []
    for split, s in sorted(found.items()):
        n, mean = s[0, 0], s[0, 1:] / s[0, 0]
        square = np.diag(s)[1:] / n
        cov = s[1:, 1:] / n - np.outer(mean, mean)
        still = np.diag(cov) <= 1e-13 * square
        cov[still, :], cov[:, still] = 0.0, 0.0
        std = np.where(still, 1.0, np.sqrt(np.where(still, 1.0, np.diag(cov))))[:-1]
        c, cy = cov[:-1, :-1] / np.outer(std, std), cov[:-1, -1] / std
        for model, alpha, l1_ratio in models:
            w = elastic_net(c, cy, alpha, l1_ratio) if l1_ratio else ridge(c, cy, n, alpha)
            out.append({"split_id": split, "model": model, "train_rows": int(n), "intercept": float(mean[-1] + shifts[-1]),
                        "means": [float(m + a) for m, a in zip(mean[:-1], shifts)], "stds": std.tolist(), "coefficients": w.tolist()})
    return out


_FITTED = "split_id int, model string, train_rows long, intercept double, means array<double>, stds array<double>, coefficients array<double>"


def coefficient_table(spark, fitted: list[dict], features) -> DataFrame:
    """(split_id, model, feature, coefficient, mean, std, intercept, train_rows)."""
    rows = spark.createDataFrame(fitted, _FITTED).select(
        "*", F.posexplode(F.arrays_zip("coefficients", "means", "stds")).alias("at", "v"))
    return rows.select("split_id", "model", F.array(*[F.lit(f) for f in features])[F.col("at")].alias("feature"),
                       F.col("v.coefficients").alias("coefficient"), F.col("v.means").alias("mean"), F.col("v.stds").alias("std"),
                       "intercept", "train_rows")


def predict_splits(df: DataFrame, windows, fitted: list[dict], features, label: str, date_col: str = "sales_month") -> DataFrame:
    """The validation rows of every split under every model: columns of ``df``, split_id,
    model, y_true, y_pred (null where a feature is).  The models are splits x models
    rows and are broadcast."""
    models = df.sparkSession.createDataFrame(fitted, _FITTED).select("split_id", "model", "intercept", "means", "stds", "coefficients")
    rows = in_windows(df, windows, "val", date_col).join(F.broadcast(models), "split_id")
    x = F.array(*[F.col(f).cast("double") for f in features])
    z = F.zip_with(F.zip_with(x, "means", lambda v, m: v - m), "stds", lambda v, s: v / s)
    y = F.aggregate(F.zip_with(z, "coefficients", lambda v, w: v * w), F.col("intercept"), lambda a, v: a + v)
    return rows.select(*df.columns, "split_id", "model", F.col(label).alias("y_true"), y.alias("y_pred"))

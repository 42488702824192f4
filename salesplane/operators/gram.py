"""Sums of products of all column pairs in one pass.

A task adds up, over its Arrow batches, six k x k matrices (count, sums, squares and
products over the rows where both columns are present), of values shifted by the
columns' means (or numbers near them), so large means cost no digits.  It yields one row for each column;
Spark adds the tasks' rows up in two steps.  Correlations of any number of columns
and the uncentred Gram matrix follow from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Matrices: n, sums of x and of y, squares of x and of y, products.
PARTS = ("n", "sx", "sy", "sxx", "syy", "sxy")
#: Groups into which the tasks' rows are added up first.
FAN = 64


def _means(df: DataFrame, cols, chunk: int = 80) -> list[float]:
    """Mean of each column's finite values (0 without any), in chunks of aggregates."""
    out = []
    for i in range(0, len(cols), chunk):
        x = [F.col(c).cast("double") for c in cols[i:i + chunk]]
        row = df.agg(*[F.avg(F.when(F.abs(c) < float("inf"), c)).alias(f"m{j}") for j, c in enumerate(x)]).first()
        out += [0.0 if m is None else float(m) for m in row]
    return out


def pair_moments(df: DataFrame, cols, shifts=None) -> tuple[DataFrame, list[float]]:
    """((i, n, sx, sy, sxx, syy, sxy), shifts): for column i arrays over all columns j of
    the moments of the rows in which both are finite; x is column i, y column j, each
    less its shift.  Nulls, NaN and infinite values are absent.  ``shifts``: numbers near
    the columns' means, for a ``df`` that is dear to run twice; by default the means."""
    cols, shifts = list(cols), _means(df, cols) if shifts is None else list(shifts)
    k = len(cols)
    fields = ", ".join(f"{p} array<double>" for p in PARTS)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        total = np.zeros((len(PARTS), k, k))
        for pdf in batches:
            x = pdf.to_numpy(dtype=np.float64, na_value=np.nan) - np.array(shifts)
            m = np.isfinite(x).astype(np.float64)
            x = np.where(m > 0, x, 0.0)
            total += (m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x)
        fan = TaskContext.get().partitionId() % FAN
        yield pd.DataFrame({"i": np.arange(k, dtype=np.int32), "fan": np.full(k, fan, np.int32),
                            **{p: list(total[j]) for j, p in enumerate(PARTS)}})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"][:1], "fan": pdf["fan"][:1], **{p: [np.sum(pdf[p].tolist(), axis=0)] for p in PARTS}})

    schema = f"i int, fan int, {fields}"
    rows = df.select(*[F.col(c).cast("double").alias(f"c{j}") for j, c in enumerate(cols)]).mapInPandas(partial, schema)
    return rows.groupBy("i", "fan").applyInPandas(add, schema).groupBy("i").applyInPandas(add, schema).drop("fan"), shifts


def correlations(df: DataFrame, cols, shifts=None) -> DataFrame:
    """(feature_a, feature_b, corr, n) of all ordered pairs; Pearson's r over the rows where
    both are finite, null if either is constant there."""
    moments, _ = pair_moments(df, cols, shifts)
    names = F.array(*[F.lit(c) for c in cols])
    long = moments.select("i", F.posexplode(F.arrays_zip(*PARTS)).alias("j", "v")).select("i", "j", "v.*")
    n, vx = F.col("n"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    # A variance below the rounding error of its terms is that of a constant.
    tiny_x, tiny_y = 1e-13 * F.col("n") * F.col("sxx"), 1e-13 * F.col("n") * F.col("syy")
    r = (n * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(vx) * F.sqrt(vy))
    r = F.when((n > 1) & (vx > tiny_x) & (vy > tiny_y), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return long.select(names[F.col("i")].alias("feature_a"), names[F.col("j")].alias("feature_b"), r.alias("corr"), n.cast("long").alias("n"))


def target_correlations(df: DataFrame, features, target: str, shifts=None) -> DataFrame:
    """(feature, abs_corr) of every feature with the target."""
    return (correlations(df, [*features, target], shifts).where((F.col("feature_b") == target) & (F.col("feature_a") != target))
            .select(F.col("feature_a").alias("feature"), F.abs("corr").alias("abs_corr")))


def high_pairs(corr: DataFrame, above: float = 0.95) -> DataFrame:
    """Q3: unordered pairs whose |r| exceeds ``above``, of a ``correlations`` result."""
    return corr.where((F.col("feature_a") < F.col("feature_b")) & (F.abs("corr") > above)).select("feature_a", "feature_b", "corr")


def gram_matrix(df: DataFrame, cols) -> np.ndarray:
    """Uncentred sums of products; k x k numbers reach the driver.  Every column has to
    be finite in all rows that count (others are absent from their pairs)."""
    moments, shifts = pair_moments(df, cols)
    rows = {r["i"]: r for r in moments.collect()}
    m = {p: np.array([rows[i][p] for i in range(len(cols))]) for p in PARTS}
    a = np.array(shifts)
    return m["sxy"] + a[None, :] * m["sx"] + a[:, None] * m["sy"] + m["n"] * np.outer(a, a)

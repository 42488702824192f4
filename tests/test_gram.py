"""Pair moments against numpy."""

import math

import numpy as np
from pyspark.sql import functions as F

from salesplane.operators import gram


def test_correlations_of_pairs_with_gaps(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + 1e6
    x[:, 4] = 3.25
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    rows[0][1], rows[1][2] = math.nan, math.inf
    cols = list("abcde")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(7)
    a = np.array([[np.nan if v is None or not math.isfinite(v) else v for v in r] for r in rows])
    got = {(r["feature_a"], r["feature_b"]): (r["corr"], r["n"]) for r in gram.correlations(df, cols).collect()}
    assert len(got) == 25
    for i, p in enumerate(cols):
        for j, q in enumerate(cols):
            both = np.isfinite(a[:, i]) & np.isfinite(a[:, j])
            corr, n = got[p, q]
            assert n == both.sum()
            if "e" in (p, q):
                assert corr is None
            else:
                assert abs(corr - np.corrcoef(a[both, i], a[both, j])[0, 1]) < 1e-9
    assert gram.correlations(df.limit(0), cols).where("corr is not null").count() == 0
    assert {tuple(r)[:2] for r in gram.high_pairs(gram.correlations(df.withColumn("f", F.col("a") * 2), ["a", "b", "f"])).collect()} >= {("a", "f")}


def test_gram_matrix_equals_plain_products(spark):
    x = np.random.default_rng(2).normal(size=(200, 4)) + [0, 10, 1000, -5]
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double, d double").repartition(5)
    np.testing.assert_allclose(gram.gram_matrix(df, list("abcd")), x.T @ x, rtol=1e-10)


def test_shifts_near_the_means_spare_the_pass_over_the_rows(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(120, 3)) + 1e5
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double").repartition(4)
    want = {(r[0], r[1]): r[2] for r in gram.correlations(df, list("abc")).collect()}
    monkeypatch.setattr(gram, "_means", lambda *a, **k: 1 / 0)
    got = {(r[0], r[1]): r[2] for r in gram.correlations(df, list("abc"), [1e5 + 2, 1e5 - 1, 1e5]).collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(got) == 9

"""Many quantiles at once and two-level scans against plain computations."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesplane.functions.stats import group_quantiles, quantiles
from salesplane.operators import scans

from conftest import fact

PROBS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("limit,bins", [(10_000, 1024), (3, 4)])
def test_group_quantiles_equal_numpy(spark, limit, bins):
    rng, rows = random.Random(limit), []
    for g in ("a", "b", None, "c"):
        for _ in range({"a": 200, "b": 1, None: 37, "c": 40}[g]):
            rows.append((g, rng.choice([1.5, 2.0, 1e9, -3.0, rng.random()]) if g != "c" else 7.0, rng.choice([None, float("nan"), rng.gauss(0, 1e-6), 0.0, -0.0])))
    rows += [("d", None, None), ("b", 1e6, 4.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {(r["k"], r["column"]): (r["n"], list(r["q"])) for r in group_quantiles(df, ["k"], ["x", "y"], PROBS, limit, bins).collect()}
    exp = {}
    for g in ("a", "b", None, "c", "d"):
        for i, c in ((1, "x"), (2, "y")):
            v = [r[i] for r in rows if r[0] == g and r[i] is not None and r[i] == r[i]]
            if v:
                exp[g, c] = (len(v), np.quantile(v, PROBS))
    assert got.keys() == exp.keys()
    for k, (n, q) in exp.items():
        assert got[k][0] == n
        np.testing.assert_allclose(got[k][1], q, rtol=1e-12, atol=1e-18)
    [r] = group_quantiles(df, [], ["x"], [0.5], limit, bins).collect()
    assert r["q"][0] == np.median([x for _, x, _ in rows if x is not None])


def test_quantiles_with_infinite_values(spark):
    inf = float("inf")
    rows = [(x,) for x in [-inf, -inf, 1.0, 2.0, 3.0, 4.0, inf]]
    [r] = group_quantiles(spark.createDataFrame(rows, "x double"), [], ["x"], [0.0, 0.5, 4 / 6, 1.0], 2, 4).collect()
    assert list(r["q"]) == [-inf, 2.0, 3.0, inf]


@pytest.mark.parametrize("limit, fact_column", [(10_000, False), (3, False), (3, True)])
def test_weighted_quantiles_equal_those_of_repeated_rows(spark, limit, fact_column):
    rng = random.Random(limit)
    rows = [(float(rng.choice([rng.randrange(9), rng.gauss(0, 50)])), rng.randrange(1, 6)) for _ in range(200)] + [(None, 3), (float("nan"), 2)]
    got = quantiles(spark.createDataFrame(rows, "x double, w int"), "x", PROBS, limit, 4, fact_column, weight="w")
    repeated = [x for x, w in rows if x is not None and x == x for _ in range(w)]
    np.testing.assert_allclose(got, np.quantile(repeated, PROBS), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("chunk_rows", [1, 4, 1000])
def test_two_level_scans_equal_plain_windows(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    rows = [(f"20{20 + m // 12}-{m % 12 + 1:02d}", rng.choice(["p", "p", None]), "s", rng.choice(["b", None]), f"c{i}", 1.0, i + 1.0)
            for i in range(60) for m in [rng.randrange(20)]]
    df = fact(spark, rows).withColumn("v", F.when(F.col("sales_quantity") % 4 == 0, F.col("sales_quantity")))
    ent, order = ["primary_platform", "store_name", "brand_name"], ["sales_month", "product_code"]
    w = Window.partitionBy(*ent).orderBy(*order)
    plain = df.select("product_code", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v"),
                      F.lag("sales_quantity").over(w).alias("before"), F.row_number().over(w).alias("number"))
    got = scans.last_known(df, ["v"], ent, order, chunk_rows)
    got = scans.running_number(scans.previous(got, "sales_quantity", "before", ent, order, chunk_rows), "number", ent, order)
    key = lambda r: r["product_code"]
    assert sorted(map(tuple, got.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))

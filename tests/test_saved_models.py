"""Saved and reloaded per-split models against the in-memory ones and a plain least-squares fit."""

import math
import random
from datetime import date

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from salesplane.operators import saved_models as sm

from conftest import fact

COLS = ["month", "quarter", "year_index", "price_scaled", "price_bucket"]


def rows(spark):
    rng = random.Random(5)
    out = [(f"{y}-{m:02d}", "p", "s", f"b{rng.randrange(3)}", f"c{i}", rng.choice([0.0, 10.0, 25.0, 31.5]) * q, q)
           for i, (y, m) in enumerate((y, m) for y in (2020, 2021, 2022) for m in range(1, 13) for _ in range(4)) for q in [rng.randint(1, 40)]]
    df = fact(spark, out)
    return df.withColumn("unit_price", F.when(F.col("product_code") != "c7", F.col("sales_amount") / F.col("sales_quantity"))) \
             .withColumn("sales_quantity_log", F.log1p("sales_quantity"))


WINDOWS = [(1, date(2020, 1, 1), date(2021, 1, 1)), (2, date(2010, 1, 1), date(2011, 1, 1)), (3, date(2020, 1, 1), date(2022, 1, 1))]


def test_reloaded_models_equal_those_in_memory(spark, tmp_path):
    df = rows(spark)
    trained = sm.train_splits(df, WINDOWS, str(tmp_path), "least_squares")
    assert [(t["split_id"], t["status"], t["train_rows"]) for t in trained] == [(1, "saved", 48), (2, "failed", 0), (3, "saved", 96)]
    assert trained[1]["error"] == "no training rows"
    later = df.where(F.year("sales_month") == 2022)
    got = {(r["split_id"], r["product_code"]): r["y_pred"] for r in sm.score_saved(spark, trained, later).collect()}
    assert len(got) == 2 * 48
    for k, start, end in (WINDOWS[0], WINDOWS[2]):
        own = df.where((F.col("sales_month") >= F.lit(start)) & (F.col("sales_month") < F.lit(end)))
        model = sm.pipeline("least_squares").fit(own)
        for r in model.transform(later).collect():
            assert got[k, r["product_code"]] == math.expm1(r["prediction"])
        # Encoders: plain quantiles of the training prices; a later year is unseen.
        prices = [r["unit_price"] for r in own.collect() if r["unit_price"] is not None]
        q25, q50, q75 = np.quantile(prices, [0.25, 0.5, 0.75])
        edges = sorted(set(np.quantile([p for p in prices if p != 0], [i / 50 for i in range(51)])))
        enc = PipelineModel.load(f"{tmp_path}/split-{k}").stages[0].transform(later).collect()
        for r in enc:
            p = r["unit_price"]
            assert r["year_index"] == 0 and r["quarter"] == (r["month"] + 2) // 3
            assert abs(r["price_scaled"] - ((p - q50) / ((q75 - q25) or 1.0))) < 1e-9
            assert abs(r["price_bucket"] - min(51, sum(e <= p for e in edges))) <= sum(abs(e - p) < 1e-9 for e in edges)
        # Predictions: a plain least-squares fit on the encoded training rows.
        x = np.array([[1.0] + [float(r[c]) for c in COLS] for r in model.stages[0].transform(own).collect()])
        y = np.array([r["sales_quantity_log"] for r in own.collect()])
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        for r in enc:
            plain = float(np.array([1.0] + [float(r[c]) for c in COLS]) @ beta)
            assert abs(math.expm1(plain) - got[k, r["product_code"]]) < 1e-4 * max(1.0, abs(math.expm1(plain)))


def test_report_has_a_row_for_every_split(spark, tmp_path):
    df = rows(spark)
    trained = sm.train_splits(df, WINDOWS, str(tmp_path), "ridge")
    got = {r["split_id"]: r for r in sm.holdout_report(spark, trained, df.where(F.year("sales_month") == 2022)).collect()}
    assert got[1]["status"] == got[3]["status"] == "saved" and got[1]["rmse"] > 0
    assert got[2]["status"] == "failed" and got[2]["rmse"] is None and got[2]["error"] == "no training rows"
    none = sm.train_splits(df.limit(0), WINDOWS, str(tmp_path), "ridge")
    assert sm.score_saved(spark, none, df) is None and sm.holdout_report(spark, none, df).count() == 3

"""Ridge, elastic net, interval joins and committed snapshots against plain versions."""

import json
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import SF
from salesplane.functions import constants as K
from salesplane.operators import calendar as cal
from salesplane.operators import intervals as iv
from salesplane.operators import linear
from salesplane.operators import splits as sp
from salesplane.plans.base import base
from salesplane.sources import committed as cm

D0 = date(2000, 1, 1)
WINDOWS = [(1, D0, date(2000, 5, 1), date(2000, 5, 1), date(2000, 7, 1), "a"),
           (2, D0, date(2000, 9, 1), date(2000, 9, 1), date(2000, 11, 1), "b"),
           (3, date(1990, 1, 1), date(1991, 1, 1), D0, date(2000, 2, 1), "no training rows")]
FEATURES = ["a", "b", "c", "e"]


def _rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4)) * [1, 5, 0.1, 0] + [1e5, -3, 0, 7]
    x[:, 2] += 0.02 * x[:, 1]
    y = 2 * (x[:, 0] - 1e5) - 0.7 * x[:, 1] + rng.normal(size=600)
    days = [date(2000, 1 + i % 12, 1) for i in range(600)]
    rows = [[d, *map(float, r), float(v)] for d, r, v in zip(days, x, y)]
    rows[0][1], rows[13][5], rows[26][2], rows[3][0] = None, None, float("nan"), None
    return rows


def _plain(rows, lo, hi, alpha, l1_ratio):
    keep = [r for r in rows if r[0] is not None and lo <= r[0] < hi and all(v is not None and np.isfinite(v) for v in r[1:])]
    x, y = np.array([r[1:5] for r in keep]), np.array([r[5] for r in keep])
    std = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    z, t = (x - x.mean(axis=0)) / std, y - y.mean()
    if not l1_ratio:
        return len(y), y.mean(), np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ t)
    w = np.zeros(4)  # proximal gradient, not coordinate descent
    step = 1 / (np.linalg.eigvalsh(z.T @ z / len(y)).max() + alpha * (1 - l1_ratio))
    for _ in range(20_000):
        g = w - step * (z.T @ (z @ w - t) / len(y) + alpha * (1 - l1_ratio) * w)
        w = np.sign(g) * np.maximum(np.abs(g) - step * alpha * l1_ratio, 0)
    return len(y), y.mean(), w


def test_linear_models_of_splits(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "day date, a double, b double, c double, e double, y double").repartition(5)
    fitted = linear.fit_splits(df, WINDOWS, FEATURES, "y", "day")
    assert [(f["split_id"], f["model"]) for f in fitted] == [(k, m) for k in (1, 2) for m in ("ridge", "elastic_net")]
    for f in fitted:
        alpha, l1_ratio = {m: r for m, *r in linear.MODELS}[f["model"]]
        n, mean, w = _plain(rows, *WINDOWS[f["split_id"] - 1][1:3], alpha, l1_ratio)
        assert f["train_rows"] == n and abs(f["intercept"] - mean) < 1e-9
        np.testing.assert_allclose(f["coefficients"], w, atol=1e-7)
        assert f["coefficients"][3] == 0 and f["stds"][3] == 1
    pred = linear.predict_splits(df, WINDOWS, fitted, FEATURES, "y", "day").collect()
    by = {(f["split_id"], f["model"]): f for f in fitted}
    assert len(pred) == 2 * sum(r[0] is not None and any(w[3] <= r[0] < w[4] for w in WINDOWS[k:k + 1]) for r in rows for k in (0, 1))
    for p in pred:
        f = by[p["split_id"], p["model"]]
        x = [p[c] for c in FEATURES]
        if None in x:
            assert p["y_pred"] is None
        elif not any(np.isnan(x)):
            assert abs(p["y_pred"] - f["intercept"] - np.dot((np.array(x) - f["means"]) / f["stds"], f["coefficients"])) < 1e-8
    assert linear.coefficient_table(spark, fitted, FEATURES).count() == 16
    assert linear.fit_splits(df.limit(0), WINDOWS, FEATURES, "y", "day") == []


def test_coefficients_come_from_the_whole_history(spark):
    b = base(spark, SF)
    rows = queries()["m16_linear_coefficients"](spark, SF).select("split_id", "train_rows").distinct().collect()
    latest = b.agg(F.max("sales_month")).first()[0]
    quarter = date(latest.year, latest.month - (latest.month - 1) % 3, 1)
    assert max(r["train_rows"] for r in rows) == b.where(F.col("sales_month") < F.lit(quarter)).count()
    first = b.agg(F.min("sales_month")).first()[0].year
    assert [r["split_id"] for r in sorted(rows)] == list(range(1, 4 * (latest.year - first - 1) + quarter.month // 3 + 2))


def test_no_windows_give_no_models(spark):
    rows = spark.createDataFrame([(D0, 1.0, 2.0)], "sales_month date, a double, y double")
    assert sp.windows_of(rows) == sp.windows_of(rows.limit(0)) == []
    assert linear.fit_splits(rows, [], ["a"], "y") == []


def test_interval_join_equals_nested_loops(spark):
    rng = random.Random(3)
    day = lambda: D0 + timedelta(days=rng.randrange(-400, 800))
    points = [(i, day()) for i in range(300)] + [(300, None), (301, D0), (301, D0)]
    spans = [(i, s, s + timedelta(days=rng.choice([0, 0, 1, 2, 3, 7, 8, 30, 31, 64, 365, 1000]))) for i, s in enumerate([day() for _ in range(120)])]
    spans += [(200, None, D0), (201, D0, None), (202, D0, D0 - timedelta(days=1)), (203, D0, D0), (203, D0, D0), (204, date(1960, 1, 1), date(2030, 1, 1))]
    p, s = spark.createDataFrame(points, "p int, at date"), spark.createDataFrame(spans, "s int, lo date, hi date")
    got = iv.interval_join(p, s, "at", "lo", "hi")
    exp = sorted((a, b) for a, at in points for b, lo, hi in spans if at and lo and hi and lo <= at <= hi)
    assert sorted((r["p"], r["s"]) for r in got.collect()) == exp
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert iv.interval_join(p, s.limit(0), "at", "lo", "hi").count() == 0
    assert iv.interval_join(p.limit(0), s, "at", "lo", "hi").columns == ["p", "at", "s", "lo", "hi"]
    with pytest.raises(ValueError):
        iv.interval_join(p, s.withColumnRenamed("s", "p"), "at", "lo", "hi")


def test_calendar_by_join_equals_arrays(spark):
    dates = spark.range(0, 3 * 366).select(F.date_add(F.lit(D0), F.col("id").cast("int")).alias("d"))
    names = [n for n, *_ in K.PROMO_EVENTS]
    events = iv.yearly_events(spark, K.PROMO_EVENTS, range(1998, 2006))
    cols = ["d", "is_promotional_period", *[cal.event_column(n) for n in names], "days_to_next_promo", "days_from_last_promo", "true_days_since_last_promo"]
    quoted = [f"`{c}`" for c in cols]
    arrays = cal.calendar_features(dates)
    # An array's anchors are those of the date's own year; so are the intervals' here, except at its ends.
    near_end = (F.dayofyear("d") <= 20) | (F.dayofyear("d") >= 346)
    joined = iv.calendar_by_join(dates.unionByName(dates.limit(5)), events, "d", names)
    assert joined.count() == dates.count()
    a, j = (sorted(tuple(r) for r in t.where(~near_end).select(*quoted).collect()) for t in (arrays, joined))
    assert a == j
    ends = [sorted(tuple(r) for r in t.where(near_end).select("d", "days_to_next_promo", "days_from_last_promo", "true_days_since_last_promo").collect())
            for t in (arrays, joined)]
    assert ends[0] == ends[1]
    empty = iv.calendar_by_join(dates.limit(3).unionByName(spark.sql("SELECT CAST(NULL AS date) AS d")), events.limit(0), "d", names)
    assert [r["is_promotional_period"] for r in empty.collect()] == [0] * 4


def test_committed_snapshots(spark, tmp_path):
    root = str(tmp_path / "snap")
    a = spark.range(50).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), F.col("id"))).alias("v"))
    with pytest.raises(cm.SnapshotError):
        cm.read(spark, root)
    first = cm.commit(a, root, ["k"], {"note": "first"})
    assert first["version"] == 1 and first["rows"] == 50 and cm.manifest_of(spark, root)["note"] == "first"
    assert cm.digest(a) == {k: first[k] for k in ("rows", "checksum")}
    assert sorted(cm.read(spark, root, verify=True).collect()) == sorted(a.collect())
    # A write killed half-way: data without a manifest, and a manifest still under its other name.
    a.limit(7).write.parquet(f"{root}/data/half")
    (tmp_path / "snap/manifests/.half").write_text("{")
    assert cm.versions(spark, root) == [1] and cm.read(spark, root).count() == 50
    second = cm.commit(a.where("id < 20"), root)
    assert second["version"] == 2 and cm.read(spark, root, verify=True).count() == 20
    assert cm.read(spark, root, version=1, verify=True).count() == 50
    assert cm.commit(a.limit(0), root)["rows"] == 0 and cm.read(spark, root, verify=True).count() == 0
    with pytest.raises(cm.SnapshotError):
        cm.read(spark, root, version=9)
    manifest = tmp_path / "snap/manifests/00000002.json"
    manifest.write_text(json.dumps({**json.loads(manifest.read_text()), "checksum": "1"}))
    (tmp_path / "snap/manifests/.00000002.json.crc").unlink(missing_ok=True)
    with pytest.raises(cm.SnapshotError):
        cm.read(spark, root, version=2, verify=True)


def test_column_reports_and_input_checks(spark):
    from salesplane.operators import quality as qa
    rows = [("x", 1.0, D0), ("x", 1.0, D0), ("y", 0.0, None), (None, -2.0, date(2001, 5, 5)), ("z", float("inf"), D0), ("x", float("nan"), D0), ("y", None, D0)]
    df = spark.createDataFrame(rows, "name string, v double, d date")
    got = {(r["column_name"], r["metric"], r["text"] if r["metric"] == "level" else None): (r["value"], r["text"]) for r in qa.integrity_report(df).collect()}
    assert got["*", "rows", None][0] == 7 and got["*", "duplicate_rows", None][0] == 1 and got["*", "total_missing", None][0] == 3
    assert got["name", "level", "x"][0] == 3 and got["name", "unique_count", None][0] == 3 and got["v", "infinite", None][0] == 1
    assert got["v", "zeros", None][0] == 1 and got["v", "negatives", None][0] == 1 and got["d", "last_day", None][1] == "2001-05-05"
    assert ("name", "level", "x") not in {(r["column_name"], r["metric"], r["text"]) for r in qa.integrity_report(df, 2).collect()}
    assert {r["metric"]: r["value"] for r in qa.integrity_report(df.limit(0)).where("column_name = '*'").collect()}["rows"] == 0
    levels = {r["column_name"]: r.asDict() for r in qa.level_report(qa.value_counts(df, ["name", "d"]), 2, 2).collect()}
    assert levels["name"] == {"column_name": "name", "unique_count": 3, "missing": 1, "first_values": "x, y", "levels": None}
    assert levels["d"]["levels"] == "2000-01-01=5, 2001-05-05=1"
    checks = {r["input"]: r for r in qa.prepared_input_checks(df, ["v"]).collect()}["v"]
    assert (checks["present"], checks["nan"], checks["infinite"], checks["min"], checks["max"], checks["mean"], checks["fails"]) == (4, 2, 1, -2, 1, 0, 1)
    ok = qa.training_issues(df.withColumn("y", F.col("d").cast("string").substr(6, 2).cast("double")), ["v"], [(1, D0, date(2001, 1, 1), date(2001, 5, 1), date(2001, 6, 1), "")],
                            "y", ("name",), "d")
    assert ok == {"issues": [], "passed": True}
    bad = qa.training_issues(df.withColumn("y", F.lit(1.0)), ["v", "w"], WINDOWS[:1], "y", ("name", "store"), "d")
    assert not bad["passed"] and bad["issues"] == ["missing required columns: store", "1 of 2 features missing: w", "split 1 has no val rows", "target has no spread"]
    assert qa.training_issues(df, [], [], "v", ())["issues"][0] == "no splits"

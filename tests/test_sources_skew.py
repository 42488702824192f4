from pyspark.sql import functions as F

from conftest import SF, fact
from salesplane.operators import skew
from salesplane.operators import temporal as tp
from salesplane.plans.base import base
from salesplane.sources import files


def _counts(df, cols):
    import collections
    return collections.Counter(tuple(r) for r in df.select(*cols).collect())


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_chunked_windows_equal_unchunked(spark):
    b = base(spark, SF)
    cols = [*tp.KEYS] if hasattr(tp, "KEYS") else ["sales_month", *tp.ENTITY, "product_code"]
    feats = ["sales_lag_1", "sales_lag_12", "amount_lag_6", "sales_rolling_mean_12", "sales_rolling_q75_6",
             "sales_trend_6m", "sales_mom_change", "sales_acceleration", "sales_yoy_growth", "momentum_6m",
             "trend_consistency_3m", "momentum_acceleration"]
    plain = tp.advanced_momentum(tp.rolling_and_momentum(tp.yoy_lags(tp.lag_features(b))))
    chunked = skew.sequence_features(b, chunk_rows=5)
    assert chunked.count() == b.count()
    a = _rows(plain.select(*cols, *[F.round(c, 9).alias(c) for c in feats]), [*cols, *feats])
    c = _rows(chunked.select(*cols, *[F.round(c, 9).alias(c) for c in feats]), [*cols, *feats])
    assert a == c


def test_rows_with_null_keys_stay(spark):
    b = base(spark, SF).limit(60)
    for c in ("primary_platform", "store_name", "brand_name", "sales_month"):
        b = b.unionByName(b.limit(9).withColumn(c, F.lit(None).cast(b.schema[c].dataType)))
    b = b.dropDuplicates([*tp.ENTITY, 'sales_month', 'product_code']).persist()
    cols = ["sales_lag_1", "sales_lag_12", "sales_rolling_mean_3", "sales_yoy_growth", "momentum_3m"]
    keys = ["sales_month", *tp.ENTITY, "product_code", "sales_quantity"]
    exp = _counts(tp.advanced_momentum(tp.rolling_and_momentum(tp.yoy_lags(tp.lag_features(b)))), [*keys, *cols])
    assert _counts(skew.sequence_features(b, chunk_rows=3), [*keys, *cols]) == exp
    assert _counts(skew.sequence_features(b), [*keys, *cols]) == exp and sum(exp.values()) == b.count()
    b.unpersist()


def test_snapshot_and_package_round_trip(spark, tmp_path):
    b = base(spark, SF).drop("secondary_platform")
    meta = files.save_snapshot(b, str(tmp_path / "snap"), str(tmp_path / "snap.json"))
    back = files.load_snapshot(spark, str(tmp_path / "snap"))
    assert back.count() == meta["rows"] == b.count()
    assert back.where(F.col("year") == 1999).count() == b.where(F.year("sales_month") == 1999).count()
    m = files.save_package(b, str(tmp_path / "pkg"), ["unit_price"], {"x": ["unit_price"]}, [])
    df, meta2 = files.load_package(spark, str(tmp_path / "pkg"))
    assert df.count() == b.count() and meta2["total_records"] == m["total_records"]


def test_load_raw_union_and_translate(spark, tmp_path):
    b = base(spark, SF).select("sales_month", "primary_platform", "store_name", "brand_name", "product_code",
                                "sales_amount", "sales_quantity")
    y1 = b.where(F.year("sales_month") == 1999).withColumnRenamed("sales_month", "销售月份") \
          .withColumnRenamed("sales_quantity", "销售数量")
    y2 = b.where(F.year("sales_month") == 2000).drop("product_code")
    y1.write.parquet(str(tmp_path / "1999.parquet"))
    y2.write.parquet(str(tmp_path / "2000.parquet"))
    assert files.missing_inputs(spark, str(tmp_path), [1999, 2000, 2001]) == [str(tmp_path / "2001.parquet")]
    raw = files.load_raw(spark, str(tmp_path), [1999, 2000, 2001])
    assert raw.count() == y1.count() + y2.count()
    assert {"sales_month", "sales_quantity", "product_code"} <= set(raw.columns)
    assert raw.where(F.col("product_code").isNull()).count() == y2.count()


def test_csv_partitioned_export(spark, tmp_path):
    b = base(spark, SF).select("primary_platform", "store_name", "sales_quantity")
    files.export_csv(b, str(tmp_path / "csv"), partition_by=["primary_platform"])
    back = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
    assert back.count() == b.count()
    assert back.select("primary_platform").distinct().count() == b.select("primary_platform").distinct().count()


def test_side_outputs(spark, tmp_path):
    from conftest import fact
    df = fact(spark, [("2021-01", "A", "s", "b", "p", 5, 0), ("2021-02", "A", "s", "b", "p", 5, -1), ("2022-01", "B", "s", "b", "q", 5, 3)])
    meta = files.save_snapshot(df, str(tmp_path / "snap"), str(tmp_path / "snap.json"))
    assert meta["months_covered"] == {"2021": [1, 2], "2022": [1]} and meta["platform_names"] == ["A", "B"]
    assert meta["issues"] == ["1 rows with negative sales", "1 rows with zero sales, over 10%"]
    assert "negative sales" in (tmp_path / "snap.txt").read_text()
    assert files.snapshot_summary(df.limit(0))["issues"] == []
    files.save_package(df, str(tmp_path / "pkg"), ["unit_price", "x_lag_1"], {"price": ["unit_price"], "lags": ["x_lag_1"], "none": []}, [], {"version": 2}, csv=True)
    listed = (tmp_path / "pkg/features.txt").read_text()
    assert "price (1):" in listed and "all features (2):" in listed and "none" not in listed
    assert "product_code: 2" in (tmp_path / "pkg/metadata.txt").read_text()
    assert spark.read.option("header", "true").csv(str(tmp_path / "pkg/csv")).count() == 3
    per = df.groupBy("primary_platform").count()
    files.save_evaluation(per, str(tmp_path / "eval"))
    assert spark.read.json(str(tmp_path / "eval/results")).count() == spark.read.option("header", "true").csv(str(tmp_path / "eval/summary")).count() == 2
    for name, fmt in (("r.json", "json"), ("r.csv", "csv"), ("r.parquet", "parquet"), ("r.pkl", "parquet"), ("r", "json")):
        out = files.save_results(per, str(tmp_path / name))
        assert out.endswith("r.parquet" if name == "r.pkl" else name)
        assert spark.read.format(fmt).option("header", "true").load(out).count() == 2
    stamped = files.save_results(per, str(tmp_path / "t.csv"), timestamp=True)
    assert stamped.startswith(str(tmp_path / "t_")) and stamped.endswith(".csv")


def test_month_chunks_need_no_row_numbers(spark):
    rows = [(f"2020-{m:02d}", "p", "s", "b", f"c{i}", 1.0, m * 10.0 + i) for m in range(1, 7) for i in range(5)]
    b = fact(spark, rows)
    got = skew.chunk_with_halo(b, chunk_rows=10, halo=3)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "Union" not in plan
    for chunk, own in got.where("not _halo").groupBy("_chunk").count().collect():
        assert own == 10
        last = {r[0] for r in b.where(F.month("sales_month") == 2 * chunk).orderBy(F.desc("product_code")).limit(3).select("sales_quantity").collect()}
        assert last <= {r[0] for r in got.where((F.col("_chunk") == chunk) & F.col("_halo")).select("sales_quantity").collect()}

"""File sources and sinks.

Raw yearly files are read with Spark's CSV / Parquet readers (Excel has no
Spark reader; export the sheets to CSV or Parquet).  Snapshots are written as
Parquet partitioned by year, so later year / month predicates prune files;
the engineered package is a Parquet table plus a small JSON side file (feature
list, categories, split windows, metadata) instead of a pickled dict.  Splits
are stored as their date windows, never as copies of the data.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as cl


def _reader(spark: SparkSession, fmt: str, schema=None):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
        if schema is None:
            r = r.option("inferSchema", "true")
    return r.format(fmt)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def missing_inputs(spark: SparkSession, root: str, years, fmt: str = "parquet") -> list:
    """Yearly input paths that do not exist (checked on the cluster file system)."""
    return [f"{root.rstrip('/')}/{y}.{fmt}" for y in years if not _exists(spark, f"{root.rstrip('/')}/{y}.{fmt}")]


def load_raw(spark: SparkSession, root: str, years, fmt: str = "parquet", schema=None,
             translate: bool = True) -> DataFrame:
    """Read ``{root}/{year}.{fmt}`` for each year present, skip missing
    ones, fail when none exist; union by column name (missing columns -> NULL),
    then P1 header translation and P3 month parsing."""
    frames = []
    for y in years:
        path = f"{root.rstrip('/')}/{y}.{fmt}"
        if not _exists(spark, path):
            continue
        frames.append(_reader(spark, fmt, schema).load(path))
    if not frames:
        raise FileNotFoundError(f"no input files for years {list(years)} under {root}")
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    if translate:
        df = cl.translate_columns(df)
        if "sales_month" in df.columns:
            df = cl.parse_month(df)
    return df


def clean_raw(df: DataFrame) -> DataFrame:
    """Cleaning chain of the reference's preprocessing."""
    df = cl.map_platforms(df)
    df = cl.fill_unknown_dims(df)
    return cl.clean_infinite_values(cl.add_unit_price(df))


def snapshot_summary(df: DataFrame, date_col: str = "sales_month", zero_share: float = 0.1) -> dict:
    """Rows, first and last date, platforms, the months each year covers and the issues
    found: negative sales, and zero sales in more than ``zero_share`` of the rows."""
    q = F.col("sales_quantity")
    row = df.agg(F.count("*").alias("rows"), F.min(date_col).alias("start"), F.max(date_col).alias("end"), F.count_if(q < 0).alias("negative"),
                 F.count_if(q == 0).alias("zero"), F.sort_array(F.collect_set("primary_platform")).alias("platforms"),
                 F.collect_set(F.date_format(date_col, "yyyy-MM")).alias("months")).first()
    months: dict[str, list[int]] = {}
    for m in sorted(row["months"]):
        months.setdefault(m[:-3], []).append(int(m[-2:]))
    issues = [f"{row['negative']} rows with negative sales"] if row["negative"] else []
    if row["zero"] > zero_share * row["rows"]:
        issues.append(f"{row['zero']} rows with zero sales, over {zero_share:.0%}")
    return {"rows": row["rows"], "start": str(row["start"]), "end": str(row["end"]), "platforms": len(row["platforms"]),
            "platform_names": row["platforms"], "months_covered": months, "issues": issues, "columns": df.columns}


def _summary_text(title: str, meta: dict) -> str:
    """``meta`` as readable lines."""
    lines = [title, ""]
    for key, value in meta.items():
        if isinstance(value, dict):
            lines += [f"{key}:", *[f"  {k}: {v}" for k, v in value.items()]]
        elif isinstance(value, list):
            lines += [f"{key} ({len(value)}):", *[f"  - {v}" for v in value]]
        else:
            lines.append(f"{key}: {value}")
    return "\n".join(lines) + "\n"


def save_snapshot(df: DataFrame, path: str, meta_path: str | None = None,
                  date_col: str = "sales_month") -> dict:
    """Parquet snapshot partitioned by year; with ``meta_path`` its ``snapshot_summary`` as
    JSON there and as text beside it (.txt)."""
    (df.withColumn("year", F.year(date_col)).write.mode("overwrite").partitionBy("year").parquet(path))
    meta = snapshot_summary(df, date_col)
    if meta_path:
        _write_json(df.sparkSession, meta_path, meta)
        _write_text(df.sparkSession, meta_path.removesuffix(".json") + ".txt", _summary_text("Sales data snapshot", meta))
    return meta


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Read a snapshot back (year partitions are pruned by year predicates)."""
    return spark.read.parquet(path)


def save_package(df: DataFrame, path: str, features, categories: dict, split_windows, extra: dict | None = None,
                 csv: bool = False) -> dict:
    """Engineered package = Parquet data, JSON side file, the feature list by category
    (features.txt), readable metadata (metadata.txt) and, with ``csv``, the data as CSV."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/data")
    meta = {"features": list(features), "categories": categories,
            "splits": [{"split_id": k, "train": [str(a), str(b)], "val": [str(c), str(d)], "description": desc}
                       for k, a, b, c, d, desc in split_windows],
            "total_records": df.count(), **(extra or {})}
    root, spark = path.rstrip("/"), df.sparkSession
    _write_json(spark, f"{root}/package.json", meta)
    named = {**{c: list(f) for c, f in categories.items() if f}, "all features": list(features)}
    _write_text(spark, f"{root}/features.txt", _summary_text("Modelling features", named))
    known = {c for c, _ in df.dtypes}
    ranges = df.agg(*[F.min("sales_month").alias("start"), F.max("sales_month").alias("end")] if "sales_month" in known else [F.lit(None).alias("start")],
                    *[F.count_distinct(c).alias(c) for c in ("primary_platform", "store_name", "brand_name", "product_code") if c in known]).first().asDict()
    _write_text(spark, f"{root}/metadata.txt", _summary_text("Engineered dataset", {
        "total_records": meta["total_records"], "total_features": len(meta["features"]), "values": ranges,
        "splits": [f"{s['split_id']}: {s['train']} -> {s['val']} {s['description']}" for s in meta["splits"]], **(extra or {})}))
    if csv:
        export_csv(df, f"{root}/csv")
    return meta


def load_package(spark: SparkSession, path: str):
    """Round trip of ``save_package``."""
    df = spark.read.parquet(f"{path.rstrip('/')}/data")
    meta = json.loads("\n".join(r.value for r in spark.read.text(f"{path.rstrip('/')}/package.json").collect()))
    return df, meta


def export_csv(df: DataFrame, path: str, partition_by=None) -> None:
    """CSV export with header; ``partition_by=['primary_platform']`` gives one
    directory per platform (S9) without a driver-side loop."""
    w = df.write.mode("overwrite").option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def export_predictions(pred: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Detailed predictions and the summary projection (columns that exist)."""
    summary_cols = [c for c in ["split_id", "sales_month", "primary_platform", "store_name", "brand_name",
                                "y_true", "y_pred", "percentage_error"] if c in pred.columns]
    pred.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/detailed")
    pred.select(*summary_cols).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/summary")


def save_evaluation(per_split: DataFrame, path: str) -> None:
    """The metrics of each split as JSON lines (``results``) and as CSV (``summary``)."""
    per_split.write.mode("overwrite").json(f"{path.rstrip('/')}/results")
    export_csv(per_split, f"{path.rstrip('/')}/summary")


#: Suffix -> format of ``save_results``; any other name is Parquet.
RESULT_FORMATS = {".json": "json", ".csv": "csv", ".parquet": "parquet"}


def save_results(df: DataFrame, path: str, timestamp: bool = False) -> str:
    """A metric table in the format of the path's suffix (one file per task, no driver
    collect); other suffixes become .parquet, none is JSON lines.  ``timestamp`` goes before
    the suffix.  Returns the path written."""
    folder, _, name = path.rstrip("/").rpartition("/")
    stem, dot, end = name.rpartition(".") if "." in name.lstrip(".") else (name, "", "")
    suffix = f"{dot}{end}"
    if suffix and suffix not in RESULT_FORMATS:
        suffix = ".parquet"
    if timestamp:
        stem = f"{stem}_{datetime.now():%Y%m%d_%H%M%S}"
    out = f"{folder}/{stem}{suffix}" if folder else f"{stem}{suffix}"
    fmt = RESULT_FORMATS.get(suffix, "json")
    (df.write.mode("overwrite").option("header", "true") if fmt == "csv" else df.write.mode("overwrite")).format(fmt).save(out)
    return out


def _write_json(spark: SparkSession, path: str, obj) -> None:
    """Write a small JSON document."""
    _write_text(spark, path, json.dumps(obj, indent=2, default=str))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text through the cluster file system (not a local path)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(conf).create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()

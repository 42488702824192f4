"""Snapshots that are whole or absent.

A write goes into a folder of its own beside the earlier ones; its manifest (rows,
checksum, columns, folder) is written under another name and renamed to the next
version number last.  Readers trust manifests only, so a write that was killed
half-way is never read, and earlier versions stay readable while one is made.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import _write_json


class SnapshotError(ValueError):
    """No committed version, a lost race for a version, or data that differ from their manifest."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/manifests/{version:08d}.json"


def digest(df: DataFrame) -> dict:
    """Row count and a checksum that does not depend on the order of rows or columns."""
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("s")).first()
    return {"rows": row["n"], "checksum": str(row["s"] or 0)}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def commit(df: DataFrame, path: str, partition_by=(), extra: dict | None = None) -> dict:
    """Write ``df`` as the next version of ``path`` and return its manifest.

    Rows and checksum are those of the files as written, read back.  Two writers
    that race for a version both write whole data; one rename wins and the other
    raises SnapshotError.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    folder = f"data/{uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    version = max(versions(spark, root), default=0) + 1
    back = spark.read.schema(df.schema).parquet(f"{root}/{folder}")
    manifest = {"version": version, "folder": folder, "columns": df.columns, "schema": df.schema.json(), **digest(back), **(extra or {})}
    fs, final = _fs(spark, _manifest(root, version))
    _, beside = _fs(spark, f"{root}/manifests/.{uuid4().hex}")
    _write_json(spark, beside.toString(), manifest)
    if fs.exists(final) or not fs.rename(beside, final):
        raise SnapshotError(f"version {version} of {root} was committed by another writer")
    return manifest


def manifest_of(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """Manifest of a version, by default the latest one."""
    have = versions(spark, path)
    if not have or (version is not None and version not in have):
        raise SnapshotError(f"{path} has no committed version" + (f" {version}" if version is not None else ""))
    text = spark.read.text(_manifest(path, have[-1] if version is None else version), wholetext=True).first()
    return json.loads(text["value"])


def read(spark: SparkSession, path: str, version: int | None = None, verify: bool = False) -> DataFrame:
    """The rows of a committed version, columns as they were written.  ``verify`` reads
    them once more and raises SnapshotError if rows or checksum differ from the manifest."""
    from pyspark.sql.types import StructType
    m = manifest_of(spark, path, version)
    df = spark.read.schema(StructType.fromJson(json.loads(m["schema"]))).parquet(f"{path.rstrip('/')}/{m['folder']}").select(*[F.col(f"`{c}`") for c in m["columns"]])
    if verify and digest(df) != {"rows": m["rows"], "checksum": m["checksum"]}:
        raise SnapshotError(f"version {m['version']} of {path} differs from its manifest")
    return df

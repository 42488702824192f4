"""Spark session and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a cluster job wants regardless of data size: AQE re-plans shuffles at
# runtime (coalescing small partitions, splitting skewed join partitions), UTC
# keeps month arithmetic stable, and the UI stays off (no extra server).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Feature tables are wide; keep codegen on for them.
    "spark.sql.codegen.maxFields": "400",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "salesplane", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset so the submit-time configuration wins.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if master and master.startswith("local") and not (extra or {}).get("spark.driver.memory"):
        b = b.config("spark.driver.memory", os.environ.get("SALESPLANE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one when unset.

    A locally created directory is only ever chosen in local mode (tests);
    on a cluster the shared folder named in the configuration is used.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="salesplane-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

"""Shared helpers: staged tables in the cluster's shared folder, connected
components, array access for Python tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesplane.session import ensure_checkpoint_dir


#: Tables of up to so many short rows are broadcast, larger ones are shuffled.
BROADCAST_ROWS = 500_000


def if_small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


_HASH_SPACE = 1 << 40


def hash_sample(df: DataFrame, columns: list[str], rows: int, total: int) -> DataFrame:
    """The ``rows`` rows of ``df`` with the smallest hash of ``columns``, smallest
    first, of ``total`` rows.  Rows beyond a hash that some four times as many fall
    under are dropped before the sort, so what the tasks send to it doesn't grow
    with the input.  A few rows less may come where hashes fall very unevenly."""
    h = F.pmod(F.xxhash64(*columns), F.lit(_HASH_SPACE))
    share = (4 * rows + 100) / max(total, 1)
    return (df if share >= 1 else df.where(h < int(share * _HASH_SPACE))).orderBy(h, *columns).limit(rows)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: "F.Column") -> "F.Column":
    """128 bits of the text's SHA-256; copies share it."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, computes ``df`` exactly once.
    The folder is the one ``spark.checkpoint.dir`` names; the files live as
    long as the checkpoint folder does."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def min_doc_components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (u long, v long).

    Returns (node, component): one row per node that is not the smallest of its
    component, ``component`` being that smallest id.  Alternating large-star /
    small-star rounds; the per-node minima are staged before they are joined,
    so a hot node's rows are split by AQE's skew join, and nothing but two
    checksums reaches the driver.  Self links and nulls are ignored.
    """
    a, b = F.col("u"), F.col("v")
    e = staged(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    while True:
        sym = e.unionByName(e.select(b.alias("u"), a.alias("v")))
        least = staged(sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = staged(sym.join(least, "u").where(b > a).select(b.alias("u"), F.col("m").alias("v")).distinct())
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")))
        e = staged(large.join(least, "u").where(b != F.col("m")).select(b.alias("u"), F.col("m").alias("v"))
                   .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        row = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == mark or row[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(row)

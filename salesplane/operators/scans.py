"""Ordered features that look back without a bound, on an entity of any size.

A trailing frame fits a chunk with a copy of a few predecessors; a running number
or the last value known does not.  These are two-level scans: the row index comes
from per-(entity, month) counts, each chunk of an entity is scanned by itself, the
chunks' summaries (one row for each) are scanned over the entity, and what they
carry is joined back.  No window is partitioned by a raw entity key but those over
the counts and summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import CHUNK_ROWS, chunked, with_row_index
from .temporal import ENTITY, ORDER


def running_number(df: DataFrame, out: str, entity=ENTITY, order=ORDER) -> DataFrame:
    """1-based number of the row in its entity."""
    return with_row_index(df, entity, order).withColumn(out, F.col("_idx") + 1).drop("_idx")


def last_known(df: DataFrame, cols, entity=ENTITY, order=ORDER, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``cols`` with nulls replaced by the entity's last non-null value so far."""
    d = with_row_index(df, entity, order).withColumn("_chunk", F.floor(F.col("_idx") / chunk_rows))
    keys = [*entity, "_chunk"]
    ends = d.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_idx"))).alias(f"_l_{c}") for c in cols])
    before = Window.partitionBy(*entity).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                        *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_l_{c}") for c in cols])
    carry = carry.where(F.col(f"_k{len(entity)}") > 0)
    own = Window.partitionBy(*keys).orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", *[F.last(c, ignorenulls=True).over(own).alias(f"_o_{c}") for c in cols])
    d = d.join(carry, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left")
    return d.select(*[F.coalesce(f"_o_{c}", f"_l_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def previous(df: DataFrame, value: str, out: str, keys, order, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The entity's value one row before."""
    def features(x, ent):
        return x.withColumn(out, F.lag(value, 1).over(Window.partitionBy(*ent).orderBy(*order)))

    return chunked(df, features, chunk_rows, 1, list(keys), list(order))

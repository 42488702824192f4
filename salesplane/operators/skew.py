"""Skew-safe evaluation of the ordered per-entity features.

``Window.partitionBy(entity)`` sends every row of one entity to one task; if
one entity holds a third of the data, that task holds a third of the data.
Lags and trailing ROWS frames only look back a bounded number of rows (at most
``halo`` = 12), so an entity can be cut into fixed-size row chunks that are
processed independently, each carrying a copy of the previous chunk's last
``halo`` rows:

1. per (entity, month) row counts (a small aggregate) give each month's first
   position in its entity and its chunk, ``first position // chunk_rows``: a chunk
   is a run of whole months;
2. the counts are joined to the rows (broadcast when their counted size allows),
   and one ``explode`` emits a row into its own chunk and, flagged, into the later
   chunks that need its month among their ``halo`` predecessors;
3. the unchanged window features run partitioned by (entity, _chunk), the only
   shuffle and sort of the rows;
4. halo copies are dropped.

The result equals the unchunked computation row for row, null keys included
(keys are matched null-safely), and it is the only path at every size.
Whole-entity statistics (z-scores, entity means, seasonal consistency) are not
frame-bounded and are computed as grouped aggregates joined back, which partial
aggregation already splits.  A task orders ``chunk_rows`` rows and two months of an
entity at most.  ``with_row_index``, for the unbounded scans, numbers the rows of an
(entity, month), as many as the products an entity sold in a month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import temporal as tp
from . import wide
from .behaviour import DEFAULT_BROADCAST_BYTES

#: Rows of an entity that one task orders, and rows that a frame looks back.
CHUNK_ROWS = 200_000
HALO = 12

ENTITY = tp.ENTITY


def with_row_index(df: DataFrame, entity=ENTITY, order=tp.ORDER) -> DataFrame:
    """Add ``_idx``: 0-based position of the row in its entity's ``order`` (by month first)."""
    keys = [*entity, order[0]]
    w = Window.partitionBy(*entity).orderBy(order[0])
    cnt = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    cnt = cnt.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order[1:])) - 1
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return (df.withColumn("_within", within).join(cnt, same)
            .withColumn("_idx", F.col("_off") + F.col("_within")).drop("_off", "_within", *[f"_k{i}" for i in range(len(keys))]))


def month_chunks(df: DataFrame, chunk_rows: int = CHUNK_ROWS, halo: int = HALO, entity=ENTITY, order=tp.ORDER,
                 counts: DataFrame | None = None) -> DataFrame:
    """One row per (entity, month): the keys as ``_k0``, ``_k1``, ... and ``_chunks``, the
    month's own chunk and then the later ones with a row at most ``halo`` rows after it.
    ``counts``: the rows of every (entity, month) as ``_n``, if they are known."""
    keys = [*entity, order[0]]
    w = Window.partitionBy(*entity).orderBy(order[0])
    cnt = df.groupBy(*keys).agg(F.count("*").alias("_n")) if counts is None else counts.select(*keys, "_n")
    cnt = cnt.withColumn("_upto", F.sum("_n").over(w))
    cnt = cnt.withColumn("_off", F.col("_upto") - F.col("_n")).withColumn("_chunk", F.floor(F.col("_off") / chunk_rows))
    # every month has a row, so at most ``halo`` later months are so near
    after = w.rowsBetween(0, halo)
    cnt = cnt.select("*", F.collect_list("_off").over(after).alias("_offs"), F.collect_list("_chunk").over(after).alias("_chunks"))
    near = F.zip_with("_chunks", "_offs", lambda c, o: F.when(o < F.col("_upto") + halo, c))
    return cnt.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                      F.array_distinct(F.array_compact(near)).alias("_chunks"))


def chunk_with_halo(df: DataFrame, chunk_rows: int = CHUNK_ROWS, halo: int = HALO, entity=ENTITY,
                    order=tp.ORDER, counts: DataFrame | None = None) -> DataFrame:
    """Each row in its own chunk, plus a flagged copy in every later chunk that has one of
    its month's rows among the ``halo`` predecessors of its first row."""
    keys = [*entity, order[0]]
    months = month_chunks(df, chunk_rows, halo, entity, order, counts).persist()
    if months.count() * (32 * len(keys) + 96) <= DEFAULT_BROADCAST_BYTES:
        months = F.broadcast(months)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return (df.join(months, same).select(*df.columns, F.posexplode("_chunks").alias("_copy", "_chunk"))
            .withColumn("_halo", F.col("_copy") > 0).drop("_copy"))


def chunked(df: DataFrame, features, chunk_rows: int = CHUNK_ROWS, halo: int = HALO, entity=ENTITY,
            order=tp.ORDER, counts: DataFrame | None = None) -> DataFrame:
    """``features(rows, entity)`` evaluated per (entity, chunk); its lags and frames
    may look back ``halo`` rows in all."""
    out = features(chunk_with_halo(df, chunk_rows, halo, entity, order, counts), [*entity, "_chunk"])
    return out.where(~F.col("_halo")).drop("_chunk", "_halo")


#: Columns that the features of ``sequence_features`` read.
SEQUENCE_INPUTS = (*ENTITY, *tp.ORDER, "sales_quantity", "sales_amount", "unit_price")
#: Its integer columns, all of them flags (0 or 1).
SEQUENCE_FLAGS = ("momentum_up", "momentum_down", "momentum_stable", "yoy_trend_up", "yoy_trend_down", "yoy_trend_stable")


def packed_sequence_features(df: DataFrame, chunk_rows: int = CHUNK_ROWS, keep=(), counts: DataFrame | None = None) -> DataFrame:
    """``sequence_features`` with its columns packed (``operators.wide``), but for its
    inputs, ``keep`` and the last step's."""
    plain = {*SEQUENCE_INPUTS, *keep}

    def features(x, ent):
        own = {*plain, *ent, "_halo"}
        x = wide.pack(tp.lag_features(x, entity=ent), own)
        x = wide.pack(tp.yoy_lags(x, entity=ent), own)
        # the volatility of W6-W11 reads the deviations of W3-W5, W16 the change of W6
        x = wide.pack(tp.rolling_features(x, entity=ent), own | {"sales_rolling_std_3", "sales_rolling_std_6"})
        x = wide.pack(tp.momentum_features(x, entity=ent), own | {"sales_mom_change"})
        return tp.advanced_momentum(x, entity=ent)

    return chunked(wide.pack(df, plain), features, chunk_rows, counts=counts)


def sequence_features(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """W1 lags, W3-W11 rolling and momentum, W12 year over year, W14-W16, in one
    chunked pass."""
    return wide.unpack(packed_sequence_features(df, chunk_rows))

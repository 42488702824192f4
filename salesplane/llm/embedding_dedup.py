"""Embedding near-duplicates: spherical k-means cells, blocked cosine products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, if_small, min_doc_components, read_table, staged

THRESHOLD = 0.95
#: Bounds of the k-means fit: distinct vectors sampled, cells, rounds.
SAMPLE = 16_384
MAX_CELLS = 4096
ROUNDS = 8
#: Vector lengths for which cells are fitted.
MAX_FITS = 4
#: Standard deviations by which a pair may straddle a border between cells.
MARGIN_Z = 5.0
#: Vectors of one cell that one task compares with all the cell's members.
BLOCK = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.stack(column.to_numpy()).astype(np.float64))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centroids of the unit rows ``x``; starts from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        home = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        size = np.linalg.norm(total, axis=1)
        c = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], c)
    return c


def fit_margin(x: np.ndarray, threshold: float, z: float = MARGIN_Z) -> float:
    """How far a partner's similarity to the other's cell may lie below its best.

    A partner lies within r = sqrt(2 - 2 * threshold); along one direction the
    difference has a standard deviation of about r / sqrt(effective dimensions),
    and borders between cells run across c - c', at most sqrt(2) long for
    centroids on one side.  r * sqrt(2) would hold for every pair but prunes
    nothing in many dimensions.
    """
    spread = np.linalg.eigvalsh(np.atleast_2d(np.cov(x.T))) if len(x) > 1 else np.ones(1)
    spread = np.clip(spread, 0, None)
    dims = spread.sum() ** 2 / max((spread ** 2).sum(), 1e-300) if spread.sum() > 0 else 1.0
    r = np.sqrt(max(0.0, 2 - 2 * threshold))
    return float(np.sqrt(2) * r * min(1.0, z / np.sqrt(max(dims, 1.0))))


def valid_vector() -> "F.Column":
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda v: v != 0), F.lit(False))


def _links(reps: DataFrame, n: int, threshold: float) -> DataFrame:
    """(id, other, links) of the distinct vectors ``reps`` (embedding, id, copies)
    of one length: a row with ``links`` for each vector, and links
    (id, other) that connect what is linked."""
    sample = hash_sample(reps.select("embedding"), ["embedding"], SAMPLE, n).toPandas()
    x = _matrix(sample["embedding"])
    centroids = spherical_kmeans(x, int(min(MAX_CELLS, max(1, round(np.sqrt(n))))))
    margin = fit_margin(x, threshold)

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"cell": (_matrix(pdf["embedding"]) @ centroids.T).argmax(1)})

    sizes = reps.select("embedding").mapInPandas(homes, "cell int").groupBy("cell").count().collect()
    parts = np.ones(len(centroids), np.int64)  # at most MAX_CELLS values
    for r in sizes:
        parts[r["cell"]] = -(-r["count"] // BLOCK)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A vector leads in its own cell and is a member of every cell that may
        hold the home of a partner."""
        for pdf in batches:
            for lo in range(0, len(pdf), 2048):
                own = pdf.iloc[lo:lo + 2048]
                near = _matrix(own["embedding"]) @ centroids.T
                home = near.argmax(1)
                row, cell = np.nonzero(near >= near.max(1, keepdims=True) - margin)
                times = parts[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                ids = own["id"].to_numpy(np.int64)
                lead = (ids ^ (ids >> 17)) * 0x9E3779B1 % parts[home]
                rows = np.concatenate([np.arange(len(own)), row])
                out = own.iloc[rows]
                yield pd.DataFrame({"cell": np.concatenate([home, cell]), "part": np.concatenate([lead, part]),
                                    "member": np.repeat([0, 1], [len(own), len(row)]), "id": out["id"].to_numpy(),
                                    "copies": out["copies"].to_numpy(), "embedding": out["embedding"].to_numpy()})

    dealt = reps.mapInPandas(deal, _dealt_schema(reps))
    return _compared(dealt, threshold)


def _dealt_schema(reps: DataFrame) -> str:
    kind = reps.schema["embedding"].dataType.simpleString()
    return f"cell int, part int, member int, id long, copies long, embedding {kind}"


def _rare_links(reps: DataFrame, lengths: DataFrame, threshold: float) -> DataFrame:
    """As _links, for vectors of the ``lengths`` (dims, count), all lengths in one
    pass: each is one cell, whose vectors are all compared, in blocks."""
    parts = F.ceil(F.col("count") / BLOCK).cast("int")
    rows = reps.join(if_small(lengths), F.size("embedding") == F.col("dims")).withColumn("parts", parts)
    lead = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (rows.select(F.col("dims").alias("cell"), lead.alias("part"), F.lit(0).alias("member"), "id", "copies", "embedding")
             .unionByName(rows.select(F.col("dims").alias("cell"), every.alias("part"), F.lit(1).alias("member"), "id", "copies", "embedding")))
    return _compared(dealt, threshold)


def _compared(dealt: DataFrame, threshold: float) -> DataFrame:
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Over rows sorted by (cell, part, member): the leads of a part are held,
        its members stream past them."""
        key, x, ids, links, label = None, None, None, None, None

        def counted():
            return pd.DataFrame({"id": ids, "other": ids, "links": links})

        for pdf in batches:
            keys = pdf[["cell", "part"]].to_numpy(np.int64)
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(pdf)]])):
                if lo == hi:
                    continue
                if key is None or (keys[lo] != key).any():
                    if ids is not None:
                        yield counted()
                    key, x, ids, links, label = keys[lo], None, np.empty(0, np.int64), np.empty(0, np.int64), None
                own = pdf.iloc[lo:hi]
                leads, members = own[own["member"] == 0], own[own["member"] == 1]
                if len(leads):
                    own_x = _matrix(leads["embedding"])
                    x = own_x if x is None else np.concatenate([x, own_x])
                    ids = np.concatenate([ids, leads["id"].to_numpy(np.int64)])
                    links = np.concatenate([links, leads["copies"].to_numpy(np.int64) - 1])
                    label = np.arange(len(ids))
                if x is None:
                    continue
                for at in range(0, len(members), BLOCK):
                    block = members.iloc[at:at + BLOCK]
                    other = block["id"].to_numpy(np.int64)
                    hit = (_matrix(block["embedding"]) @ x.T) >= threshold
                    links = links + (hit & (other[:, None] != ids[None])).T @ block["copies"].to_numpy(np.int64)
                    out = []
                    for j in np.flatnonzero((hit & (other[:, None] != ids[None])).any(1)):
                        at_leads = np.flatnonzero(hit[j])
                        roots, first = np.unique(label[at_leads], return_index=True)
                        out += [(other[j], ids[i], -1) for i in at_leads[first] if ids[i] != other[j]]
                        if len(roots) > 1:
                            label[np.isin(label, roots)] = roots[0]
                    if out:
                        yield pd.DataFrame(out, columns=["id", "other", "links"])
        if ids is not None:
            yield counted()

    return (dealt.repartition("cell", "part").sortWithinPartitions("cell", "part", "member")
            .mapInPandas(compare, "id long, other long, links long"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``
    (vec_id, embedding: array of float or double; other columns are not read).

    Equal vectors are one node with a number of copies.  Distinct ones are
    compared, in double precision, within the cells of a spherical k-means fitted
    on a bounded sample; a vector is compared in its own cell with that cell's
    vectors and all whose similarity to it lies within a margin of their best.
    Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without vec_id, link with nothing and are kept; vectors of different
    lengths are not compared (the MAX_FITS most frequent lengths have cells of their
    own; vectors of each other length are all compared, in blocks).  Each row counts as a vector,
    so repeated rows link with each other.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding")
    reps = staged(rows.where(valid_vector()).groupBy("embedding")
                  .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    lengths = staged(reps.groupBy(F.size("embedding").alias("dims")).count())
    sizes = lengths.orderBy(F.col("count").desc(), "dims").limit(MAX_FITS + 1).collect()
    found = spark.createDataFrame([], "id long, other long, links long")
    for r in sizes[:MAX_FITS]:
        found = found.unionByName(_links(reps.where(F.size("embedding") == r["dims"]), r["count"], threshold))
    if len(sizes) > MAX_FITS:
        rare = lengths.where(~F.col("dims").isin([r["dims"] for r in sizes[:MAX_FITS]]))
        found = found.unionByName(_rare_links(reps, rare, threshold))
    found = staged(found)
    parts = min_doc_components(found.where("links < 0").select(F.col("id").alias("u"), F.col("other").alias("v")))
    counts = found.where("links >= 0").select("id", "links")
    classes = staged(reps.select("embedding", "id").join(counts, "id").join(parts, F.col("id") == F.col("node"), "left")
                     .select(F.col("embedding").alias("same"), "links", F.coalesce("component", "id").alias("least")))
    return (rows.join(classes, (F.col("embedding") == F.col("same")) & F.col("vec_id").isNotNull(), "left")
            .select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("least", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))

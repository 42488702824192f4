"""SimHash near-duplicates through covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import if_small, min_doc_components, read_table, staged

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BITS = 64
#: Distinct fingerprints compared in one bucket; fuller buckets are split.
BUCKET = 4096
_CHUNK = 1 << 16


def simhash(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash over the text's k-word shingles, repeats included.

    A-Z are lower-cased; words are separated by ASCII white space.  Fewer than
    k words make one shingle, no word (or null) gives zero.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    buf = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends[min(k, len(words)) - 1:] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(ends), _CHUNK):
        h = np.array([digest(buf[s:e], SEED) for s, e in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs``."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, k) for t in texts], dtype="int64")

    return docs.select("doc_id", fp("text").alias("fp"))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks; two values at most ``radius`` bits apart agree on
    all bits of some mask.  Bit i carries a non-zero vector m(i) of radius + 1
    bits, mask v has the bits with odd <m(i), v>: at most ``radius`` vectors
    always leave a v that is orthogonal to them all."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if ((1 + i % n) & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _parts(mask: int, parts: int) -> list[int]:
    """``mask`` joined with each of ``parts`` blocks of the bits it leaves free."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [_signed(mask | sum(1 << int(i) for i in block)) for block in np.array_split(free, parts)]


def _forest(fp: np.ndarray, ids: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what lies within ``radius`` bits, at most one per value."""
    out, rest = [], np.arange(len(fp))
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.bitwise_count(fp[front[:256], None] ^ fp[None, rest]) <= radius
            got = near.any(0)
            if got.any():
                out.append((ids[front[:256]][near[:, got].argmax(0)], ids[rest[got]]))
            front = np.concatenate([front[256:], rest[got]])
            rest = rest[~got]
    return out


def _linker(radius: int, bucket: int):
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Over rows sorted by (mask, key): links within complete buckets, and the
        rows of overfull ones under ``radius`` + 1 finer masks each."""
        held, full = None, None

        def split(rows: np.ndarray) -> pd.DataFrame:
            finer = [m for m in _parts(int(rows[0, 0]) & (1 << BITS) - 1, radius + 1)]
            return pd.DataFrame({"mask": np.repeat(finer, len(rows)), "fp": np.tile(rows[:, 2], len(finer)),
                                 "id": np.tile(rows[:, 3], len(finer)), "other": 0})

        def links(rows: np.ndarray) -> pd.DataFrame:
            cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(1)) + 1
            lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(rows)]])
            fp, ids, out = np.ascontiguousarray(rows[:, 2]).view(np.uint64), rows[:, 3], []
            two = lo[hi - lo == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
            out.append((ids[two], ids[two + 1]))
            for a, b in zip(lo[hi - lo > 2], hi[hi - lo > 2]):
                out += _forest(fp[a:b], ids[a:b], radius)
            a, b = (np.concatenate(x) for x in zip(*out))
            return pd.DataFrame({"mask": 0, "fp": 0, "id": a, "other": b})

        for pdf in batches:
            rows = pdf[["mask", "key", "fp", "id"]].to_numpy(np.int64)
            rows = rows if held is None else np.concatenate([held, rows])
            if full is not None:
                same = (rows[:, :2] == full).all(1)
                if same.any():
                    yield split(rows[same])
                rows = rows[~same]
            held = None
            if not len(rows):
                continue
            full = None
            last = int(np.argmax((rows[:, :2] == rows[-1, :2]).all(1)))
            cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(1)) + 1
            sizes = np.diff(np.concatenate([[0], cut, [len(rows)]]))
            big = np.repeat(sizes > bucket, sizes)
            for at in np.flatnonzero(sizes > bucket):
                lo = int(sizes[:at].sum())
                yield split(rows[lo:lo + int(sizes[at])])
            if sizes[-1] > bucket:
                full = rows[-1, :2].copy()
            else:
                held = rows[last:]
            done = rows[:last][~big[:last]]
            if len(done):
                yield links(np.ascontiguousarray(done))
        if held is not None and len(held):
            yield links(np.ascontiguousarray(held))

    return link


def link_fingerprints(reps: DataFrame, radius: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between ``reps`` (fp long, distinct; id long, non-null) whose
    connected components are those of "at most ``radius`` bits apart".

    Each fingerprint goes to one bucket per covering mask.  A bucket emits a
    spanning forest, never its pairs.  Buckets of more than ``bucket`` distinct
    fingerprints are dealt out again under masks that also fix one of radius+1
    blocks of the free bits (some block agrees in every pair sought), until they
    fit: with f free bits a bucket has at most 2^f members, so this ends.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])
    rows, found = reps.select(F.explode(masks).alias("mask"), "fp", "id"), None
    while rows is not None:
        dealt = (rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
                 .repartition("mask", "key").sortWithinPartitions("mask", "key", "fp"))
        out = staged(dealt.mapInPandas(_linker(radius, bucket), "mask long, fp long, id long, other long"))
        links = out.where("mask = 0").select(F.col("id").alias("u"), F.col("other").alias("v"))
        found = links if found is None else found.unionByName(links)
        rows = out.where("mask != 0").select("mask", "fp", "id")
        rows = None if rows.isEmpty() else rows
    return found


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable through links of at most
    ``radius`` differing bits.  Equal fingerprints are one node, so copies are
    never paired.  Rows that share a doc_id are kept; a null doc_id belongs to
    its fingerprint's component, which is null if no row there has an id.
    """
    fps = staged(fingerprints(docs, k))
    reps = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("id")))
    parts = min_doc_components(link_fingerprints(reps.where("id is not null"), radius))
    classes = staged(reps.join(parts, F.col("id") == F.col("node"), "left")
                     .select("fp", F.coalesce("component", "id").alias("component_id")))
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's smallest, all columns
    kept; rows without a doc_id stay."""
    gone = staged(near_duplicates(docs.select("doc_id", "text"), k, radius)
                  .where("doc_id != component_id").select(F.col("doc_id").alias("__gone")))
    return docs.join(if_small(gone), docs["doc_id"] == F.col("__gone"), "left_anti")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Exact removal of repeated 400-byte strings with per-shard suffix arrays.

A 400-byte string (a window) is anchored at the smallest hash of its 128-byte
grams, so equal windows, wherever they occur, share an anchor hash.  The windows
of a text that share an anchor form one context (a stretch of bytes).  Only
contexts whose anchor hash occurs more than once can hold repeats; they meet in
shards by that hash, and each shard's suffix array settles them.  An anchor hash
with very many contexts is salted over several shards, whose windows are then
merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import if_small, read_table, staged

WINDOW = 400
GRAM = 128
#: Contexts of one anchor hash in one shard, and bytes of one suffix array.
SHARD_CONTEXTS = 4096
SHARD_BYTES = 1 << 21
_CHUNK_BITS = 19
_LANES = 1 << 14


def _key(text: "F.Column") -> "F.Column":
    """128 bits of the text's SHA-256; copies share it."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _digest(body) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


def _words(a: np.ndarray) -> np.ndarray:
    """Little-endian 8-byte words at every offset with 8 bytes to come."""
    x = a.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    return x


def gram_hashes(a: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of the ``gram``-byte strings at every offset (a power of two
    of 8 bytes or more)."""
    h, k = _words(a), 8
    while k < gram:
        h = h[:-k] * np.uint64(0x9E3779B97F4A7C15) + (h[k:] ^ (h[k:] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        k *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    y = np.concatenate([x, np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:len(x) - w + 1], ahead[w - 1:len(x)])


def contexts_of(raw: bytes, window: int = WINDOW, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(anchor hash, first, last): the windows starting at first..last share their
    anchor, the leftmost smallest gram hash.  Every window is in one of them."""
    a, out, low = np.frombuffer(raw, np.uint8), [], np.uint64((1 << _CHUNK_BITS + 1) - 1)
    for at in range(0, len(a) - window + 1, 1 << _CHUNK_BITS):
        h = gram_hashes(a[at:at + (1 << _CHUNK_BITS) + window - 1], gram)
        where = _sliding_min(h & ~low | np.arange(len(h), dtype=np.uint64), window - gram + 1) & low
        cut = np.flatnonzero(where[1:] != where[:-1]) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(where)]]) - 1
        out += zip(h[where[first].astype(np.int64)].view(np.int64).tolist(), (first + at).tolist(), (last + at).tolist())
    return out


def suffix_array(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, ranks) by Larsson-Sadakane refinement: ranks by the first 8
    bytes, then the unsorted groups alone by the ranks h further on, h doubling."""
    n = len(buf)
    head = _words(np.concatenate([buf, np.zeros(7, np.uint8)])).byteswap()
    sa = np.argsort(head, kind="stable")
    slots, rank = np.arange(n), np.empty(n + 1, np.int64)
    new = np.concatenate([[True], head[sa][1:] != head[sa][:-1]])
    rank[sa], rank[n] = np.maximum.accumulate(np.where(new, slots, 0)), -1
    h = 8
    while len(slots):
        same = ~new
        same[:-1] |= ~new[1:]
        slots = slots[same]
        if not len(slots):
            break
        pos = sa[slots]
        group, ahead = rank[pos], rank[np.minimum(pos + h, n)]
        order = np.argsort(group * (n + 2) + ahead, kind="stable")
        pos, group, ahead = pos[order], group[order], ahead[order]
        sa[slots] = pos
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])])
        rank[pos] = np.maximum.accumulate(np.where(new, slots, 0))
        h *= 2
    return sa, rank[:n]


def common_prefixes(buf: np.ndarray, sa: np.ndarray, most: int = WINDOW) -> np.ndarray:
    """Longest common prefix of each suffix in ``sa`` with the one before it, up to
    ``most``, by Kasai's rule: at the next text position it shrinks by one at
    most.  The text is walked in many stretches side by side."""
    n = len(buf)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = _words(np.concatenate([buf, np.zeros(most + 15, np.uint8)]))
    step = -(-n // _LANES)
    starts = np.arange(0, n, step)
    plcp, length = np.zeros(n, np.int64), np.zeros(len(starts), np.int64)
    for t in range(step):
        pos = starts + t
        live = np.flatnonzero(pos < n)
        length = np.maximum(length - 1, 0)
        length[live[before[pos[live]] < 0]] = 0
        live = live[before[pos[live]] >= 0]
        while len(live):
            i, k = pos[live], length[live]
            diff = words[i + k] ^ words[before[i] + k]
            same = np.where(diff == 0, 8, np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)) // 8)
            length[live] = np.minimum(np.minimum(k + same, most), n - np.maximum(i, before[i]))
            live = live[(same == 8) & (length[live] == k + 8) & (length[live] < most)]
        ok = pos < n
        plcp[pos[ok]] = length[ok]
    return plcp[sa]


def _runs(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true ``flags``, cut before ``breaks``."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[breaks] = True
    begin = flags & (np.concatenate([[True], ~flags[:-1]]) | edge[:-1])
    end = flags & (np.concatenate([~flags[1:], [True]]) | edge[1:])
    return np.flatnonzero(begin), np.flatnonzero(end)


def _settle(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """Repeated windows within one shard's contexts: (a, c, lo, hi) offsets.  Of
    salted anchors also each distinct window once: its digest and, if it is alone
    here, where it is (else off -1)."""
    bodies = rows["body"].tolist()
    size = np.array([len(b) for b in bodies])
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    buf = np.frombuffer(b"\xff".join(bodies) + b"\xff", np.uint8)
    sa, _ = suffix_array(buf)
    run = np.cumsum(common_prefixes(buf, sa, window) < window)
    count = size - window + 1
    owner = np.repeat(np.arange(len(bodies)), count)
    first = np.cumsum(count) - count
    off = np.arange(len(owner)) - first[owner]
    is_start = np.full(len(buf), -1, np.int64)
    is_start[begin[owner] + off] = np.arange(len(owner))
    start = is_start[sa]
    run, start = run[start >= 0], start[start >= 0]
    repeated = np.zeros(len(owner), bool)
    repeated[start] = np.bincount(run)[run] > 1
    lo, hi = _runs(repeated, first)
    a, c, salted = (rows[x].to_numpy() for x in ("a", "c", "salted"))
    out = [pd.DataFrame({"a": a[owner[lo]], "c": c[owner[lo]], "lo": off[lo], "hi": off[hi], "salt": -1, "digest": 0})]
    if salted.any():
        _, pick = np.unique(run, return_index=True)
        pick = start[pick]
        pick = pick[salted[owner[pick]]]
        own = owner[pick]
        digest = [_digest(bodies[o][f:f + window]) for o, f in zip(own, off[pick])]
        at = np.where(repeated[pick], -1, off[pick])
        out.append(pd.DataFrame({"a": a[own], "c": c[own], "lo": at, "hi": at, "salt": rows["salt"].to_numpy()[own],
                                 "digest": np.array(digest, np.int64)}))
    return pd.concat(out)


def _groups(batches: Iterator[pd.DataFrame], by: list[str], least: int, weight) -> Iterator[pd.DataFrame]:
    """Sorted rows in runs of whole groups, each run of ``least`` weight or the end."""
    held, load = [], 0
    for pdf in batches:
        if not len(pdf):
            continue
        keys = pdf[by].to_numpy()
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        if held and (held[-1][by].to_numpy()[-1] != keys[0]).any() and load >= least:
            yield pd.concat(held)
            held, load = [], 0
        at = 0
        for end in (*cut, len(pdf)):
            held.append(pdf.iloc[at:end])
            load += weight(held[-1])
            at = end
            if end < len(pdf) and load >= least:
                yield pd.concat(held)
                held, load = [], 0
    if held:
        yield pd.concat(held)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """(key, spans): for each distinct text of ``docs`` (doc_id, text) that holds
    repeated windows, the byte ranges (first, end) they cover, overlapping."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                out = []
                for doc_id, key, text in pdf.iloc[lo:lo + 512].itertuples(index=False):
                    raw = memoryview(text.encode())
                    out += [(doc_id, key, s, e, a, _digest(raw[s:e + window])) for a, s, e in contexts_of(raw, window, gram)]
                yield pd.DataFrame(out, columns=["doc_id", "key", "s", "e", "a", "c"]).astype({"doc_id": "Int64"})

    texts = docs.select("doc_id", _key(F.col("text")).alias("key"), "text").where(F.octet_length("text") >= window)
    rows = staged(texts.mapInPandas(find, "doc_id long, key binary, s int, e int, a long, c long"))

    anchors = staged(rows.groupBy("a").agg(F.count("*").alias("n"), (F.min("c") != F.max("c")).alias("mixed"))
                     .where("n > 1").select("a", "mixed"))
    live = staged(rows.join(anchors, "a"))
    spans = live.where("not mixed").select("key", F.col("s").alias("first"), (F.col("e") + window).alias("end"))

    many = live.where("mixed")
    found = staged(many.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "s", "e")).alias("at")))
    salts = staged(found.groupBy("a").count().where(F.col("count") > shard_contexts).select(
        "a", F.ceil(F.col("count") / shard_contexts).cast("int").alias("salts")))
    placed = (found.select("a", "c", "at.*").join(if_small(salts), "a", "left")
              .withColumn("salted", F.col("salts").isNotNull())
              .withColumn("salt", F.coalesce(F.pmod("c", F.col("salts").cast("long")), F.lit(0)).cast("int"))
              .groupBy("key", F.col("doc_id").alias("id"))
              .agg(F.collect_list(F.struct("a", "c", "s", "e", "salt", "salted")).alias("cuts")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                out = []
                for text, cuts in pdf.iloc[lo:lo + 256].itertuples(index=False):
                    raw = text.encode()
                    out += [(x["a"], x["c"], x["salt"], x["salted"], raw[x["s"]:x["e"] + window]) for x in cuts]
                yield pd.DataFrame(out, columns=["a", "c", "salt", "salted", "body"])

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, ["a", "salt"], SHARD_BYTES, lambda g: int(g["body"].str.len().sum())):
            yield _settle(part.drop_duplicates(["a", "c"]).reset_index(drop=True), window)

    placed = staged(placed.withColumnRenamed("key", "same"))
    dealt = texts.join(placed, (F.col("key") == F.col("same")) & F.col("doc_id").eqNullSafe(F.col("id")))
    bodies = dealt.select("text", "cuts").mapInPandas(cut, "a long, c long, salt int, salted boolean, body binary")
    settled = staged(bodies.repartition("a", "salt").sortWithinPartitions("a", "salt", "c")
                     .mapInPandas(shard, "a long, c long, lo int, hi int, salt int, digest long"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Windows that another shard of their anchor holds as well: each shard's
        sorted digests are looked up in all shards' by binary search."""
        for part in _groups(batches, ["a", "bucket"], 1, len):
            digest, salt = part["digest"].to_numpy(), part["salt"].to_numpy()
            every, hit = np.sort(digest), np.zeros(len(part), bool)
            for s in np.unique(salt):
                own = np.flatnonzero(salt == s)
                mine = np.sort(digest[own])
                n_every = np.searchsorted(every, digest[own], "right") - np.searchsorted(every, digest[own], "left")
                n_mine = np.searchsorted(mine, digest[own], "right") - np.searchsorted(mine, digest[own], "left")
                hit[own] = n_every > n_mine
            yield part.loc[hit & (part["lo"].to_numpy() >= 0), ["a", "c", "lo", "hi"]]

    crossed = (settled.where("salt >= 0").join(if_small(salts), "a")
               .withColumn("bucket", F.pmod("digest", F.col("salts").cast("long")).cast("int"))
               .select("a", "c", "lo", "hi", "salt", "digest", "bucket")
               .repartition("a", "bucket").sortWithinPartitions("a", "bucket", "salt")
               .mapInPandas(merge, "a long, c long, lo int, hi int"))
    verdicts = staged(settled.where("salt < 0").select("a", "c", "lo", "hi").unionByName(crossed)
                      .unionByName(found.where("n > 1").select("a", "c", F.lit(0).alias("lo"),
                                                               (F.col("at.e") - F.col("at.s")).alias("hi"))))
    spans = spans.unionByName(many.join(verdicts, ["a", "c"]).select(
        "key", (F.col("s") + F.col("lo")).alias("first"), (F.col("s") + F.col("hi") + window).alias("end")))
    return spans.groupBy("key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def remove_spans(text: str | None, spans) -> tuple[int, int, int, str]:
    """(bytes, bytes removed, maximal removed runs, SHA-256 of what is left)."""
    raw, done, removed, runs, left = (text or "").encode(), 0, 0, 0, hashlib.sha256()
    reach = -1
    for first, end in sorted((x["first"], x["end"]) for x in (spans if spans is not None else ())):
        if first > reach:
            left.update(raw[done:first])
            runs += 1
            removed += end - first
        elif end > reach:
            removed += end - reach
        reach = done = max(reach, end)
    left.update(raw[done:])
    return len(raw), removed, runs, left.hexdigest()


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans,
    kept_sha256.

    Every byte of a ``window``-byte string that also starts elsewhere, in the same
    text or another row's, is removed; strings are judged on the input.  Null text
    is empty; texts shorter than ``window`` bytes lose nothing; repeated rows are
    copies of each other; other columns are not read.
    """
    found = staged(repeated_spans(docs, window, gram, shard_contexts).withColumnRenamed("key", "same"))

    @F.pandas_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string>")
    def apply(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([remove_spans(t, s) for t, s in zip(texts, spans)],
                            columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return (docs.select("doc_id", "text", _key(F.col("text")).alias("key")).join(found, F.col("key") == F.col("same"), "left")
            .select("doc_id", apply("text", "spans").alias("r")).select("doc_id", "r.*"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, sf_dir, "documents"))

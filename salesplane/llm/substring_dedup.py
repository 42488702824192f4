"""Exact removal of repeated 35-word windows by recompression.

A text is a sequence of word names.  In each round, runs of one symbol and then
pairs (a left-side symbol followed by a right-side one, by a bit of their names)
become new symbols.  A symbol's name is a hash of its parts, so all tasks name
equal runs and pairs alike and no table of names has to travel.  With every
symbol goes its reach: the words that decide that it stands there.  Equal windows
hold the same symbols whose reach lies within them.

A window is anchored at the symbol of the highest round within it (of these, the
one of smallest name; a third of a window has to follow its start).  The anchor's
name takes in the third of a window of words that begins at the symbol.
Windows of a text that share an anchor form one context.  Spark counts the
anchors' names over all texts: a name that occurs once holds no repeat.  Shared
names reveal the repeats: contexts of equal words are repeated whole, and where
contexts of one name differ, their windows are named and counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, if_small, read_table, staged, text_key

WINDOW = 35
ROUNDS = 4
#: Words that are parsed together, and words whose names a task remembers.
SEGMENT = 1 << 18
KNOWN_WORDS = 1 << 19
#: Rows of 64 bits in a map of hashes.
FILTER_WORDS = 1 << 20

_U = np.uint64


class _WordNames(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = name = xxhash.xxh3_64_intdigest(word)
        return name


def _namer():
    """UTF-8 text -> names of its words; bytes.split() cuts at the contract's white space."""
    known = _WordNames()

    def names(raw: bytes) -> np.ndarray:
        return np.fromiter(map(known.__getitem__, raw.split()), _U)

    return names


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _run_names(a: np.ndarray, times: np.ndarray) -> np.ndarray:
    return _mix(_mix(a + _U(0x9E3779B97F4A7C15)) + times.astype(_U))


def _pair_names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(_mix(a + _U(0xD1B54A32D192ED03)) + b * _U(0xA0761D6478BD642F))


def _compress(sym: dict[str, np.ndarray], round_: int) -> dict[str, np.ndarray]:
    """One round over symbols with ``name``, words ``start``..``end``, names of their
    ``first`` and ``last`` word, and reach ``lo``..``hi``."""
    name, n = sym["name"], len(sym["name"])
    i = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    j = np.concatenate([i[1:], [n]]) - 1
    before, after = np.maximum(i - 1, 0), np.minimum(j + 1, n - 1)
    # One differing word beside a run shows where it ends; else the whole neighbour does.
    left = np.where(sym["last"][before] != sym["last"][i], sym["start"][i] - 1, sym["lo"][before])
    right = np.where(sym["first"][after] != sym["first"][i], sym["end"][j] + 1, sym["hi"][after])
    run = {"name": np.where(j > i, _run_names(name[i], j - i + 1), name[i]), "start": sym["start"][i], "end": sym["end"][j],
           "first": sym["first"][i], "last": sym["last"][j],
           "lo": np.minimum(sym["lo"][i], left), "hi": np.maximum(sym["hi"][j], right)}

    name, n = run["name"], len(run["name"])
    right_side = (name >> _U(round_)) & _U(1) == 1
    head = np.zeros(n, bool)
    head[:-1] = ~right_side[:-1] & right_side[1:]
    tail = np.concatenate([[False], head[:-1]])
    lo = np.where(right_side, run["lo"][np.maximum(np.arange(n) - 1, 0)], run["lo"])
    hi = np.where(right_side, run["hi"], run["hi"][np.minimum(np.arange(n) + 1, n - 1)])
    i = np.flatnonzero(~tail)
    j = i + head[i]
    return {"name": np.where(head[i], _pair_names(name[i], name[j]), name[i]), "start": run["start"][i], "end": run["end"][j],
            "first": run["first"][i], "last": run["last"][j],
            "lo": np.where(head[i], run["lo"][i], lo[i]), "hi": np.where(head[i], run["hi"][j], hi[i])}


def _least(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the leftmost smallest of ``value[lo..hi]`` for each range."""
    step = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    best = np.arange(len(value))
    out = np.empty(len(lo), np.int64)
    for k in range(int(step.max()) + 1):
        if k:
            half = 1 << (k - 1)
            a, b = best[:-half], best[half:]
            best = np.where(value[a] <= value[b], a, b)
        own = np.flatnonzero(step == k)
        a, b = best[lo[own]], best[hi[own] - (1 << k) + 1]
        out[own] = np.where(value[a] <= value[b], a, b)
    return out


def contexts_of(texts: list[np.ndarray], window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(text, first, last, anchor name) arrays: the windows of a text that start at
    words first..last share their anchor.  Every window is in one context."""
    parts, owner, shift = [], [], []
    for t, w in enumerate(texts):
        for at in range(0, len(w) - window + 1, SEGMENT):
            parts.append(w[at:at + SEGMENT + window - 1])
            owner.append(t)
            shift.append(at)
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none, none
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size + 1) - size  # a border symbol before each part and after the last
    border = _mix(np.arange(len(parts) + 1, dtype=_U))
    words = np.concatenate([x for p, b in zip(parts, border) for x in (b[None], p)] + [border[-1:]])
    at = np.arange(len(words))
    sym = {"name": words, "start": at, "end": at + 1, "first": words, "last": words, "lo": at, "hi": at + 1}
    levels = [sym]
    for r in range(rounds):
        sym = _compress(sym, r)
        levels.append(sym)

    starts = size - window + 1
    part = np.repeat(np.arange(len(parts)), starts)
    off = np.arange(len(part)) - np.repeat(np.cumsum(starts) - starts, starts)
    pos = begin[part] + off
    ahead = max(1, window // 3)
    where, name, todo = np.full(len(pos), -1, np.int64), np.zeros(len(pos), _U), np.arange(len(pos))
    for r in range(rounds, -1, -1):
        sym, p = levels[r], pos[todo]
        lo, hi = np.searchsorted(sym["lo"], p, "left"), np.searchsorted(np.maximum(sym["hi"], sym["start"] + ahead), p + window, "right") - 1
        own = np.flatnonzero(lo <= hi)
        if len(own):
            best = _least(sym["name"], lo[own], hi[own])
            where[todo[own]] = sym["start"][best] * (rounds + 1) + r
            name[todo[own]] = _mix(sym["name"][best] + _U(r))
        todo = todo[lo > hi]
        if not len(todo):
            break
    cut = np.flatnonzero((where[1:] != where[:-1]) | (part[1:] != part[:-1])) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(part)]]) - 1
    name, symbol = name[first], where[first] // (rounds + 1)
    for k in range(ahead):
        name = _mix(name + words[symbol + k])
    base = np.array(shift)[part[first]]
    return np.array(owner)[part[first]], base + off[first], base + off[last], name.view(np.int64)


def _digest(words: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(words.data) - (1 << 63)


def _maybe(rows: DataFrame, names: DataFrame, by: str) -> DataFrame:
    """``rows`` without most of those whose ``by``, a hash, is not in ``names``: a bit
    map of the names, of at most FILTER_WORDS rows, drops them before a shuffle."""
    word = F.pmod(by, F.lit(FILTER_WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(by, 32), F.lit(64)).cast("int"))
    bits = staged(names.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")))
    return (rows.withColumn("word", word).join(F.broadcast(bits), "word")
            .where(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(key, spans): for each distinct text of ``docs`` (text) that holds repeated
    windows, the word ranges (first, end) they cover, overlapping."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _namer()

        def rows(keys: list[bytes], texts: list[np.ndarray]) -> pd.DataFrame:
            t, s, e, a = contexts_of(texts, window, rounds)
            c = [_digest(texts[i][x:y + window]) for i, x, y in zip(t.tolist(), s.tolist(), e.tolist())]
            return pd.DataFrame({"key": pd.Series([keys[i] for i in t.tolist()], dtype=object), "s": s.astype(np.int32), "e": e.astype(np.int32),
                                 "a": a, "c": np.array(c, np.int64)})

        for pdf in batches:
            keys, texts, load = [], [], 0
            for key, text in zip(pdf["key"], pdf["text"]):
                keys.append(key)
                texts.append(names(text.encode()))
                load += len(texts[-1])
                if load >= SEGMENT:
                    yield rows(keys, texts)
                    keys, texts, load = [], [], 0
            yield rows(keys, texts)

    # A window has its words and the white space between them.
    texts = docs.select(text_key(F.col("text")).alias("key"), "text").where(F.octet_length("text") >= 2 * window - 1)
    found = staged(texts.mapInPandas(parse, "key binary, s int, e int, a long, c long"))
    anchors = staged(found.groupBy("a").count().where("count > 1").select("a"))
    live = staged(_maybe(found, anchors, "a").join(if_small(anchors), "a"))
    discard(found)

    same = staged(live.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("key", "s", "e")).alias("at")))
    mixed = staged(same.groupBy("a").count().where("count > 1").select("a"))
    whole = same.where("n > 1").select("a", "c", F.lit(0).alias("lo"), (F.col("at.e") - F.col("at.s")).alias("hi"))

    def name_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _namer()
        for pdf in batches:
            out = []
            for text, cuts in zip(pdf["text"], pdf["cuts"]):
                w = names(text.encode())
                for x in cuts:
                    out += [(x["a"], x["c"], p - x["s"], _digest(w[p:p + window])) for p in range(x["s"], x["e"] + 1)]
                if len(out) >= SEGMENT:
                    yield pd.DataFrame(out, columns=["a", "c", "off", "h"])
                    out = []
            yield pd.DataFrame(out, columns=["a", "c", "off", "h"])

    cuts = staged(same.join(if_small(mixed), "a").select("a", "c", "at.*").groupBy(F.col("key").alias("same"))
                  .agg(F.collect_list(F.struct("a", "c", "s", "e")).alias("cuts")))
    windows = staged(texts.join(cuts, F.col("key") == F.col("same")).select("text", "cuts")
                     .mapInPandas(name_windows, "a long, c long, off int, h long"))
    # A context holds no window twice, so a window in two contexts is one that repeats.
    shared = windows.groupBy("a", "h").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 != c1").select("a", "h")
    shared = staged(shared)
    single = _maybe(windows, shared, "h").join(if_small(shared), ["a", "h"]).select("a", "c", F.col("off").alias("lo"), F.col("off").alias("hi"))

    verdicts = staged(whole.unionByName(single))
    return (_maybe(live, verdicts, "c").join(if_small(verdicts), ["a", "c"])
            .select("key", (F.col("s") + F.col("lo")).alias("first"), (F.col("s") + F.col("hi") + window).alias("end"))
            .groupBy("key").agg(F.collect_set(F.struct("first", "end")).alias("spans")))


def remove_spans(text: str | None, spans) -> tuple[int, int, str]:
    """(words, words removed, SHA-256 of the kept words joined by one space)."""
    words = (text or "").encode().split()
    gone = np.zeros(len(words) + 1, np.int64)
    for x in spans if spans is not None else ():
        gone[x["first"]] += 1
        gone[x["end"]] -= 1
    left = np.flatnonzero(np.cumsum(gone[:-1]) == 0) if len(words) else ()
    kept = b" ".join(words if len(left) == len(words) else [words[i] for i in left])
    return len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest()


def deduplicate(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_removed, kept_sha256.

    Every word covered by a ``window``-word sequence that also starts elsewhere,
    in the same text or another row's, is removed; windows are judged on the
    input.  Null text has no words; texts of fewer words lose nothing; repeated
    rows are copies of each other; an empty table gives no rows; other columns are
    not read.  Texts of any length are parsed in segments that overlap by a window.
    """
    found = staged(repeated_spans(docs, window, rounds).withColumnRenamed("key", "same"))

    @F.pandas_udf("struct<n_words:long,n_removed:long,kept_sha256:string>")
    def apply(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([remove_spans(t, s) for t, s in zip(texts, spans)], columns=["n_words", "n_removed", "kept_sha256"])

    return (docs.select("doc_id", "text", text_key(F.col("text")).alias("key")).join(found, F.col("key") == F.col("same"), "left")
            .select("doc_id", apply("text", "spans").alias("r")).select("doc_id", "r.*"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS i, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT i, p, md5(array_to_string(words[p:p + {WINDOW - 1}], ' ')) AS h
        FROM (SELECT i, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM w)),
rep AS (SELECT i, p FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT i, unnest(range(p, p + {WINDOW})) AS k FROM rep),
cut AS (SELECT i, list(k) AS gone FROM gone GROUP BY i)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words WHEN len(gone) = len(words) THEN []
              ELSE [words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(gone, j)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN cut USING (i)
"""

"""Benchmark decontamination by winnowed fingerprints; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import if_small, read_table, staged

#: Words of a window and of the k-grams whose minimum is a window's fingerprint.
WINDOW = 13
GRAM = 5
#: A document is contaminated from one hit word in so many on.
SHARE = 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of ``text`` with A-Z lower-cased; none for null."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.coalesce(F.regexp_extract_all(low, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def text_key(text: Column) -> Column:
    """128 bits of the text's SHA-256: copies share it, null has none."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _starts(n: Column, length: int) -> Column:
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def window_fingerprints(hashes: Column, length: int, gram: int = GRAM) -> Column:
    """For each window of ``length`` words, the minimum hash of its k-grams
    (k = ``gram``, or the whole window if that is shorter)."""
    k = min(gram, length)

    def grams(h):
        return F.transform(_starts(F.size(h), k), lambda i: F.xxhash64(F.slice(h, i + 1, k)))

    return let(hashes, lambda h: let(grams(h), lambda g: F.transform(
        _starts(F.size(h), length), lambda i: F.array_min(F.slice(g, i + 1, length - k + 1)))))


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def benchmark_windows(bench: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, list[int]]:
    """Distinct windows of ``bench`` (item_id, text): (length, fp, words, items),
    and the lengths that occur, ``window`` at most.  Items without id or words
    are left out; an item shorter than ``window`` is one window."""
    w = bench.where("item_id is not null").select("item_id", words(F.col("text")).alias("w"))
    w = w.withColumn("length", F.least(F.size("w"), F.lit(window))).where("length > 0")
    lengths = sorted(r[0] for r in w.select("length").distinct().collect())  # at most ``window`` values
    parts = []
    for n in lengths:
        own = w.where(F.col("length") == n)
        parts.append(own.select("item_id", "length", "w", F.posexplode(window_fingerprints(_hashes(F.col("w")), n, gram))
                                .alias("at", "fp"))
                     .select("item_id", "length", "fp", F.array_join(F.slice("w", F.col("at") + 1, n), " ").alias("words")))
    if not parts:
        return bench.sparkSession.createDataFrame([], "length int, fp long, words string, items array<bigint>"), []
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return staged(out.groupBy("length", "fp", "words").agg(F.collect_set("item_id").alias("items"))), lengths


def find_hits(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(rows, hits): rows (doc_id, key, n_words) for every row of ``docs``; hits
    (key, n_hit, items) for every text that holds a benchmark window.

    Each document window is winnowed to its minimum k-gram hash; the distinct
    ones of a text meet the benchmark's.  Only at the windows whose fingerprint
    was met are the words themselves compared.  A shared window has the same
    minimum on both sides, so none is missed.  Everything is keyed by the
    text's hash: copies are resolved once and repeated rows stay apart.
    """
    known, lengths = benchmark_windows(bench, window, gram)
    if not lengths:
        rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
        return rows, docs.sparkSession.createDataFrame([], "key binary, n_hit long, items array<bigint>")

    def prints(h):
        return F.array(*[F.struct(F.lit(n).alias("length"), F.array_distinct(window_fingerprints(h, n, gram)).alias("fps"))
                         for n in lengths])

    base = staged(docs.select("doc_id", text_key(F.col("text")).alias("key"), let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), let(_hashes(w), prints).alias("prints"))).alias("s"))
        .select("doc_id", "key", F.col("s.n").alias("n_words"), F.col("s.prints").alias("prints")))
    rows = base.select("doc_id", "key", "n_words")

    met = (base.select("key", F.explode("prints").alias("p"))
           .select("key", F.col("p.length").alias("length"), F.explode("p.fps").alias("fp"))
           .join(if_small(known.select("length", "fp").distinct()), ["length", "fp"]).distinct()
           .groupBy("key").agg(F.collect_list(F.struct("length", "fp")).alias("met")))
    met = staged(met)

    again = docs.select(text_key(F.col("text")).alias("key"), "text").join(if_small(met), "key")
    w = words(F.col("text"))

    def spans(w, met, n):
        def at_met(fps, own):
            return F.transform(F.filter(_starts(F.size(w), n), lambda i: F.array_contains(own, F.get(fps, i))),
                               lambda i: F.struct(i.alias("at"), F.lit(n).alias("length"),
                                                  F.array_join(F.slice(w, i + 1, n), " ").alias("words")))

        own = F.transform(F.filter(met, lambda m: m["length"] == n), lambda m: m["fp"])
        return let(window_fingerprints(_hashes(w), n, gram), lambda fps: let(own, lambda own: at_met(fps, own)))

    found = (again.select("key", F.explode(let(w, lambda w: F.flatten(F.array(
        *[spans(w, F.col("met"), n) for n in lengths])))).alias("s")).select("key", "s.*").distinct()
             .join(if_small(known.groupBy("length", "words").agg(F.flatten(F.collect_list("items")).alias("items"))),
                   ["length", "words"]))
    hits = (found.groupBy("key").agg(F.collect_list(F.struct("at", "length")).alias("spans"),
                                     F.collect_set("items").alias("items"))
            .select("key", F.size(F.array_distinct(F.flatten(F.transform(
                "spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))))).cast("long").alias("n_hit"),
                F.array_distinct(F.flatten("items")).alias("items")))
    return rows, hits


def _is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def scan(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_hit, n_items,
    items_sha256, contaminated.  Null or empty texts have no words and no hits;
    an empty benchmark hits nothing; other columns are not read."""
    rows, hits = find_hits(docs, bench)
    ids = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda x: x.cast("string")))
    return (rows.join(staged(hits), "key", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"))
            .withColumn("contaminated", _is_contaminated()))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, all columns kept."""
    rows, hits = find_hits(docs, bench)
    bad = staged(rows.join(staged(hits), "key").where(_is_contaminated()).select(F.col("key").alias("__bad")).distinct())
    return docs.join(if_small(bad), text_key(docs["text"]) == F.col("__bad"), "left_anti")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_LOW = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
_SQL_WORDS = rf"coalesce(regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n,
              array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS g
       FROM b, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM d, lens, unnest(range(1, greatest(len(w) - n, -1) + 2)) AS t(i)),
hit AS (SELECT DISTINCT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM hit) h, unnest(range(i, i + n)) AS t(p)
        GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

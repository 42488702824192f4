"""Hard negatives, substring removal and spelling variants against brute force and SQL."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from salesplane.llm import hard_negatives, spelling, substring_dedup

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("query,sql", [(hard_negatives.op11, hard_negatives.OP11_SQL), (substring_dedup.op12, substring_dedup.OP12_SQL)])
def test_sql(spark, query, sql):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = query(spark, SF)
    assert rows_of(got) == sorted(con.execute(sql).fetchall())
    assert got.count() > 0


# ---- hard negatives

def mined_plainly(rows, positives=5, negatives=10):
    """(vec_id, label, components) rows -> result rows, every score computed."""
    v = [(i, (label + 1) % 10 if i % 7 == 0 else label, np.floor(256 * np.array(x, np.float64)).astype(np.int64)) for i, label, x in rows]
    out = []
    for a, la, x in v:
        if a % 100:
            continue
        scored = sorted((-int(x @ y), i, label) for i, label, y in v if i != a and len(y) == len(x))
        for ps, p, _ in [s for s in scored if s[2] == la][:positives]:
            fit = [(s, i) for s, i, label in scored if label != la and 30 * -ps <= 100 * -s <= 90 * -ps][:negatives]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(fit)]
    return sorted(out)


VECTOR = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("shard_rows,block_anchors", [(16_384, 16_384), (40, 2)])
def test_hard_negatives_equal_brute_force(spark, shard_rows, block_anchors):
    rng = random.Random(7)
    # Few distinct components, so scores tie; lengths 0, 3 and 5; some zero vectors.
    rows = [(i, rng.randrange(4), [rng.choice([0.0, 0.0, 0.5, 0.25, -0.25, 1.0]) for _ in range(rng.choice([3, 3, 5, 0]))]) for i in range(900)]
    df = spark.createDataFrame([(i, x, label) for i, label, x in rows], VECTOR)
    got = hard_negatives.mine(df, shard_rows=shard_rows, block_anchors=block_anchors)
    assert rows_of(got) == mined_plainly(rows)


def test_threshold_search_stops_early():
    rng = np.random.default_rng(3)
    x = rng.integers(-5, 6, (4000, 4))
    x[:50] += 200
    shard = hard_negatives.Shard(np.arange(4000), np.zeros(4000, np.int64), x)
    met = []
    shard.floats = type("Counted", (), {"__getitem__": lambda _, rows: met.append(len(rows)) or x[rows].astype(float), "dtype": np.float64})()
    q = np.array([3, 1, 2, 1])
    [best] = shard.search(q, [(np.ones(4000, bool), -(1 << 63), 1 << 63, 5)])
    assert best == sorted(((int(s), i) for i, s in enumerate(x @ q)), key=lambda p: (-p[0], p[1]))[:5]
    assert sum(met) < 1000


def test_hard_negatives_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [0.5, 0.0], 2), (4, [0.5, 0.0], 2), (5, None, 2), (6, [0.5, None], 2),
            (8, [0.5, nan], 2), (9, [0.5, inf], 2), (10, [0.5, 0.0], None), (None, [0.5, 0.0], 2), (11, [0.6, 0.0], 2), (12, [], 2)]
    df = spark.createDataFrame(rows, VECTOR).select("*", *[F.lit("own").alias(c) for c in ("id", "x", "shard", "tag", "score", "windows")])
    # Row 0 gets label 2, so its positives are 4, 11 and 12 is too short to meet it.
    assert rows_of(hard_negatives.mine(df)) == []
    df = df.withColumn("label", F.when(F.col("vec_id") == 0, 0).when(F.col("vec_id") == 3, 1).otherwise(1 + F.col("label")))
    assert rows_of(hard_negatives.mine(df)) == [(0, 3, 1, 11, 65536, 39168), (0, 3, 2, 4, 65536, 32768)]
    assert hard_negatives.mine(df.limit(0)).count() == 0


# ---- substring removal

def removed_plainly(texts, window):
    words = [(t or "").encode().split() for t in texts]
    n = collections.Counter(tuple(w[p:p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {k for p in range(len(w) - window + 1) if n[tuple(w[p:p + window])] > 1 for k in range(p, p + window)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def patched_texts(rng, letters):
    base = [" ".join(rng.choice(letters) * rng.choice([1, 1, 2]) for _ in range(rng.randint(1, 200))) for _ in range(8)]
    return base + [" ".join(rng.choice(base).split()[rng.randint(0, 40):rng.randint(40, 200)] + rng.choice(base).split()[:rng.randint(0, 60)])
                   for _ in range(8)]


@pytest.mark.parametrize("segment", [9, 1 << 18])
def test_equal_windows_share_their_anchor(monkeypatch, segment):
    monkeypatch.setattr(substring_dedup, "SEGMENT", segment)
    rng, names = random.Random(segment), substring_dedup._namer()
    for letters in ("a", "ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"):
        for window in (3, 8, 35):
            words = [names(t.encode()) for t in patched_texts(rng, letters)]
            anchor, seen = {}, set()
            for t, first, last, a in zip(*substring_dedup.contexts_of(words, window)):
                for p in range(first, last + 1):
                    assert (t, p) not in seen
                    seen.add((t, p))
                    assert anchor.setdefault(words[t][p:p + window].tobytes(), a) == a
            assert len(seen) == sum(max(0, len(w) - window + 1) for w in words)


@pytest.mark.parametrize("letters,window", [("ab", 6), ("abcdefghijklm", 12), ("abcdefghijklmnopqrstuvwxyz", 35)])
def test_substring_removal_equals_brute_force(spark, letters, window):
    rng = random.Random(window)
    texts = patched_texts(rng, letters) + ["a " * 300, "a b\x1c " * 50, "x\ty\x0bz " * 40, None, "", " \n"]
    texts += texts[:2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in sorted(substring_dedup.deduplicate(df, window).collect())]
    assert got == removed_plainly(texts, window)


def test_substring_removal_of_odd_rows(spark):
    long = "the erly onand hewh thing " * 8000
    df = spark.createDataFrame([(None, None), (1, ""), (2, long), (2, long), (3, "w " * 34), (4, "w " * 34)], "doc_id long, text string")
    df = df.select("*", *[F.lit("own").alias(c) for c in ("key", "spans", "a", "c", "s", "e", "same", "lo", "hi")])
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring_dedup.deduplicate(df).collect())
    assert got == [(0, 0, 0), (1, 0, 0), (2, 40_000, 40_000), (2, 40_000, 40_000), (3, 34, 0), (4, 34, 0)]
    assert substring_dedup.deduplicate(df.limit(0)).count() == 0


# ---- spelling variants

def neighbours_plainly(words):
    gaps, known, out = collections.defaultdict(set), set(words), collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1:]].add(w)
    for w in words:
        for i in range(len(w)):
            out[w] |= gaps[w[:i], w[i + 1:]] - {w}
            less = w[:i] + w[i + 1:]
            if less in known:
                out[w].add(less)
                out[less].add(w)
    return out


def variants_plainly(docs, min_length=5, min_count=3, ratio=2):
    n = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= min_count}
    near = neighbours_plainly(list(n))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_ranges_build_one_trie():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"a" * 400, "a" * 401, "a" * 400 + "b"})

    def edges(own, of_first, of_last):
        depth, parent, word, ends = spelling.range_trie(own, of_first, of_last)
        return {(own[w][:depth[p]], own[w][:d], e >= 0) for d, p, w, e in zip(depth, parent, word, ends) if p >= 0}

    whole = {(a, b) for a, b, _ in edges(words, [], [])}
    for size in (1, 2, 9, 40):
        ranges = [words[i:i + size] for i in range(0, len(words), size)]
        last = [None] + [r[-1] for r in ranges]
        rows = [spelling.border_rows(r, before, after) for r, before, after in zip(ranges, last, [r[0] for r in ranges[1:]] + [None])]
        nodes = {n for r in rows for _, _, n, own in r if own}
        parts = [edges(r, *[[d for side, d, n, _ in b if side == k and n in nodes] for k in (0, 1)]) for r, b in zip(ranges, rows)]
        assert {(a, b) for p in parts for a, b, _ in p} == whole
        assert sorted(b for p in parts for _, b, e in p if e) == words


@pytest.mark.parametrize("letters,range_words", [("ab", 12), ("abcdé", 70)])
def test_neighbours_equal_brute_force(spark, letters, range_words):
    rng = random.Random(range_words)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"a" * k for k in range(1, 12)}
    words |= {"long" * 500 + x for x in ("", "s", "t", "ts", "st")}
    words = sorted(words)
    exp = neighbours_plainly(words)
    got = spelling.neighbours(spark.createDataFrame([(w,) for w in words], "word string"), range_words)
    assert rows_of(got) == sorted((w, x) for w in words for x in exp[w])


def test_spelling_variants_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {tuple(r) for r in spelling.spelling_variants(docs, range_words=500).collect()}
    assert got == variants_plainly(docs.collect())
    assert any(r[1] for r in got) and any(r[1] and r[1] != r[2] for r in got)


def test_spelling_variants_of_odd_rows(spark):
    texts = [(None, "Straße straße STRASSE Color colour color"), (2, None), (3, ""), (4, "123 ÀÉÎ ÀÉÎÕÜ àéîõü"), (4, "123 ÀÉÎ ÀÉÎÕÜ àéîõü"),
             (5, "color " * 20 + "colour " * 4 + "colours " * 2 + "STRASSE strasse"), (6, "×÷×÷× " * 3)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    df = df.select("*", *[F.lit("own").alias(c) for c in ("word", "n", "near", "node", "form", "root", "label")])
    for min_count in (1, 3):
        got = {tuple(r) for r in spelling.spelling_variants(df, min_count=min_count).collect()}
        assert got == variants_plainly(texts, min_count=min_count)
    assert spelling.spelling_variants(df.limit(0)).count() == 0

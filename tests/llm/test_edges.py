"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesplane.llm import decontaminate, embedding_dedup, html_text, language_id, license_scan, packing, pii, secret_scan, simhash, suffix_dedup

SF = "/root/testdata/sf0.001"
CLASH = ("key", "fp", "s", "e", "a", "c", "id", "node", "component", "spans", "score", "lang_pred", "rejected", "n_words", "met", "same", "g", "path")
LONG = "the erly onand hewh thing " * 8000


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents with columns of clashing names; every second row is repeated."""
    texts = [None, "", " \n\t ", "12 345 !?", "a", LONG, "Mail x.y@a.example.com or +1 (743) 555-3824", "token = \"" + "ab12" * 10 + "\"",
             "é ÉÈ ß 漢字 \U0001F600", "the erly onand hewh " * 30, "the erly onand hewh " * 30]
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += rows[::2] + [(None, "no id at all, the erly", "de", "s", 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH]).coalesce(2).persist()


def ids(df):
    return collections.Counter(r[0] for r in df.select("doc_id").collect())


def frames(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").withColumn("key", F.lit(1))
    dicts = language_id.train_dictionaries(spark.read.parquet(f"{SF}/documents.parquet"))
    return {
        "op1": lambda d: decontaminate.scan(d, bench),
        "op2": lambda d: license_scan.scan(license_scan.document_paths(d)).withColumnRenamed("id", "doc_id"),
        "op4": lambda d: suffix_dedup.deduplicate(d, window=64, gram=16),
        "op6": lambda d: pii.scan(d, pii.train(d)),
        "op7": lambda d: simhash.near_duplicates(d),
        "op8": lambda d: secret_scan.scan(d, secret_scan.train(d)),
        "op9": lambda d: language_id.predict_language(d, dicts),
    }


def test_each_row_gets_one_result(spark, odd):
    want = ids(odd)
    for name, f in frames(spark).items():
        assert ids(f(odd)) == want, name
        assert f(odd.limit(0)).count() == 0, name


def test_results_of_odd_rows(spark, odd):
    by = {n: {r["doc_id"]: r for r in f(odd).collect()} for n, f in frames(spark).items()}
    assert (by["op1"][0]["n_words"], by["op1"][0]["contaminated"], by["op1"][3]["n_words"]) == (0, False, 2)
    assert by["op2"][0]["origin"] == "none"
    assert (by["op4"][0]["n_bytes"], by["op4"][0]["n_removed"]) == (0, 0)
    assert by["op4"][9]["n_removed"] == by["op4"][9]["n_bytes"] == by["op4"][10]["n_removed"]
    assert by["op6"][0]["spans"] == "" and (by["op6"][6]["n_email"], by["op6"][6]["n_phone"]) == (1, 1)
    assert by["op7"][0]["fp"] == by["op7"][1]["fp"] == by["op7"][2]["fp"] == 0
    assert {by["op7"][i]["component_id"] for i in (0, 1, 2)} == {0} and by["op7"][10]["component_id"] == 9
    assert by["op7"][None]["component_id"] in (0, None) or by["op7"][None]["fp"] != 0
    assert by["op8"][0]["spans"] == "" and (by["op8"][7]["n_assign"], by["op8"][7]["n_hex"]) == (1, 1)
    assert [by["op9"][i]["lang_pred"] for i in (0, 1, 2, 3)] == ["und"] * 4 and by["op9"][5]["lang_pred"] == "en"


def test_packing_of_odd_rows(spark, odd):
    got = packing.pack(odd, packing.tokenizer_path())
    assert ids(got.where("piece = 0")) == ids(odd)
    assert packing.pack(odd.limit(0), packing.tokenizer_path()).count() == 0
    assert {r["length"] for r in got.where("doc_id = 0").collect()} == {1}


def test_stages_keep_columns_and_handle_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        rows = out.collect()
        assert all(r[c] == f"own {c}" for r in rows for c in CLASH), name
        assert not ids(out) - ids(odd), name
        empty = stage(spark, odd.limit(0), SF)
        assert empty.columns == odd.columns and empty.count() == 0, name
        if name == "pii":
            assert ids(out) == ids(odd)
            assert {r["text"] for r in rows if r["doc_id"] == 6} == {"Mail <EMAIL> or <PHONE>"}
        if name == "decontaminate":
            assert ids(out) == ids(odd)
        if name == "simhash_dedup":
            assert {r["doc_id"] for r in rows} >= {0, 5, 9, None} and not {r["doc_id"] for r in rows} & {1, 2, 10}
        if name == "language_id":
            assert not {r["doc_id"] for r in rows} & {0, 1, 2, 3} and 5 in {r["doc_id"] for r in rows}


def test_odd_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "u", "<p>x</p>"), (3, None, "<" * 5000), (4, "u", "<p>" + "y " * 200000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = html_text.extract_text(pages).collect()
    assert collections.Counter(r["page_id"] for r in got) == collections.Counter(r[0] for r in rows)
    assert {r["page_id"]: r["n_chars"] for r in got if r["page_id"] in (1, 2, 4)} == {1: 0, 2: 1, 4: 399999}
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (None, [1.0, 0.0]), (4, [2.0, 0.0]), (5, [0.0, 1.0]), (6, [-0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("own")).withColumn("links", F.lit("own"))
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(v).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 0, None, True), (4, 2, 1, False), (5, 0, 5, True), (6, 0, 6, True)], key=str)
    assert embedding_dedup.near_duplicates(v.limit(0)).count() == 0


def test_pipeline_is_its_stages_by_brute_force(spark):
    """run() against plain Python of every stage's rule; learned models are shared."""
    from tokenizers import Tokenizer
    from test_operators import groups
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    guess = language_id._classifier(language_id.learn(docs))
    kept = {r["doc_id"]: r["text"] for r in docs.collect() if (lambda g: g[0] != "und" and g[1] >= language_id.MIN_MARGIN)(guess(r["text"]))}
    order = sorted(kept)
    fps = [simhash.simhash(kept[i]) % 2**64 for i in order]
    root = groups(len(order), [(i, j) for i in range(len(order)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    kept = {order[i]: kept[order[i]] for i in range(len(order)) if root[i] == i}
    import re
    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {tuple(w[k:k + 13]) for w in map(words, bench) for k in range(max(1, len(w) - 12)) if w}

    def contaminated(t):
        w, hit = words(t), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
        return bool(hit) and 20 * len(hit) >= len(w)

    kept = {i: t for i, t in kept.items() if not contaminated(t)}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got["doc_id"]) == set(kept)
    model = pii.train(docs.where(F.col("doc_id").isin(list(kept))))
    tok = Tokenizer.from_file(packing.tokenizer_path())
    lengths = got.groupby("doc_id")["length"].sum()
    for i, t in kept.items():
        assert lengths[i] == len(tok.encode(pii.redact(t, model), add_special_tokens=False).ids) + 1
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    assert np.array_equal(got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")["length"].sum().to_numpy(),
                          (got["offset"] + got["length"]).groupby(got["sequence_id"]).max().to_numpy())

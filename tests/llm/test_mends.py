"""Faults found by brute force, kept from coming back."""

import collections
import functools
import hashlib
import random
import time

import numpy as np
import pandas as pd
import pytest

from salesplane.llm import boosting, embedding_dedup, html_text, language_id, license_scan, packing, pii, secret_scan, suffix_dedup

SF = "/root/testdata/sf0.01"


def test_ids_of_odd_texts_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tok, encode = Tokenizer.from_file(path), packing._encoder(path)
    rng = random.Random(11)
    texts = list(pd.read_parquet(f"{SF}/documents.parquet", columns=["text"])["text"].dropna())
    texts += ["".join(rng.choice("ABCabcÉéßÇ'’|ªµº 0-.\n\t漢") for _ in range(rng.randint(1, 30))) for _ in range(20_000)]
    for text, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == np.array(e.ids, "<u4").tobytes(), text[:80]


def test_long_tokens_are_covered_to_their_end():
    rng = random.Random(1)
    for n in (16, 255, 256, 257, 266, 271, 272, 300, 512, 520, 1000):
        token = "a1" + "".join(rng.choice("abcdefXYZ0123") for _ in range(n - 2))
        spans = secret_scan.candidates(f"x {token} y", [])
        assert spans[0][0] == 2 and spans[-1][1] == 2 + n
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and all(b - a >= 16 for a, b in spans)


def test_many_base_spans_in_one_text_take_linear_time():
    text = " ".join(f"password={i:08d}xyz A1b2C3d4E5f6G7h8{i}" for i in range(20_000))
    at = time.time()
    found = secret_scan.candidates(text, secret_scan.base_spans(text))
    assert len(found) == 20_000 and time.time() - at < 2


def test_number_signs_are_not_letters():
    assert [language_id.letters(t) for t in ("²", "½ Ⅷ ①", "_12", "x² é")] == [b"", b"", b"", "x é".encode()]


@pytest.mark.parametrize("name", ["social-history", "legal-analysis", "share-price", "sidebar-effects"])
def test_content_with_telling_names_stays_in_articles(name):
    page = "<body><nav>menu</nav><article><p>One long sentence of the article.</p><p class='{}'>Another one of it.</p>{}</article></body>"
    extra = "<div class='share-buttons'>Share</div><div class='related'>More</div><div class='social-share'>Post</div>"
    assert html_text.main_text(page.format(name, extra)) == "One long sentence of the article.\nAnother one of it."


def test_vectors_of_twenty_lengths(spark):
    rng = np.random.default_rng(4)
    rows = []
    for dims in range(1, 21):
        x = rng.normal(size=(12, dims))
        x[6:] = x[:6] + rng.normal(size=(6, dims)) * rng.choice([0.01, 0.2], 6)[:, None]
        rows += [(100 * dims + i, v.tolist()) for i, v in enumerate(x)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for dims in range(1, 21):
        own = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if len(v) == dims]
        for i, x in own:
            assert got[i][0] == sum(float(x @ y) >= 0.95 for j, y in own if j != i)


def test_notice_scores_do_not_depend_on_the_number_of_rows(spark):
    notice = "This code is released under the MIT License."
    filler = ["This is code for the reader", "a text under the tree is released", "the and in of this", "in the code of this text"]

    def score(times):
        rows = [(0, "p/0.txt", notice)] + [(i, f"p/{i}.txt", filler[i % 4]) for i in range(1, 40 * times)] + \
               [(100_000 + i, "q/x.txt", "Released under the MIT License.") for i in range(times)]
        got = license_scan.scan(spark.createDataFrame(rows, "id long, path string, text string")).where("id = 0").first()
        return got["license"], got["score"]

    small, large = score(5), score(250)
    assert small[0] == large[0] == "MIT" and abs(small[1] - large[1]) < 0.03


def test_removed_bytes_equal_those_of_plain_hashing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.select("doc_id", "text").collect()}
    seen = collections.Counter(hash(t[i:i + 400]) for t in texts.values() for i in range(len(t) - 399))
    want = {}
    for k, t in texts.items():
        gone, runs, removed, reach = [], 0, 0, -1
        for i in range(len(t) - 399):
            if seen[hash(t[i:i + 400])] > 1:
                runs += i > reach
                removed += i + 400 - max(i, reach)
                gone.append((max(i, reach), i + 400))
                reach = i + 400
        kept, at = [], 0
        for a, b in gone:
            kept.append(t[at:a])
            at = b
        want[k] = (len(t), removed, runs, hashlib.sha256(b"".join([*kept, t[at:]])).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.deduplicate(docs).collect()}
    assert got == want


def test_letters_of_accented_text_take_no_search_through_all_number_signs():
    signs = [c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
    assert all(language_id.letters(f"É{c}b") == "é b".encode() for c in signs)
    assert language_id.letters("𝔄b² _c٣\U00010400") == "𝔄b c \U00010428".encode()
    text = "élève où Straße " * 40_000
    start = time.process_time()
    language_id.letters(text)
    assert time.process_time() - start < 0.3  # 640,000 characters; 0.8 s when each is compared with every sign


def test_decoys_are_cut_from_whole_texts_in_every_alphabet():
    text = " ".join(random.Random(5).choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit"]) for _ in range(300))
    plain = len(text.replace(" ", ""))
    length = {size: len(text) if size in (64, 66) else plain for size in secret_scan.SIZES}
    got = collections.Counter()
    for (size, b, _), n in secret_scan.decoy_counts([text, "short text", ""]).items():
        got[size, b] += n
    assert got == {(size, b): -(-length[size] // n) for size in secret_scan.SIZES for b, n in enumerate(secret_scan.LENGTHS)}


def test_evidence_is_the_same_for_one_and_for_many():
    rng = np.random.default_rng(4)
    for n in (16, 24, 32, 128):
        for size in secret_scan.SIZES:
            v = rng.integers(0, size, (1500, n)).astype(np.uint8)
            v[::3] //= 3
            v[0] = 1
            many = secret_scan.evidence(v, size)
            one = [secret_scan.evidence(v[i:i + 1].astype(int), size)[0] for i in range(0, 1500, 50)]
            assert np.allclose(many[::50], one, rtol=1e-9)


def test_trees_from_sums_equal_trees_from_rows():
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 2, 3000), rng.integers(0, 400, 3000), rng.random(3000).round(2)]).astype(float)
    y = ((x[:, 1] > 150) ^ (x[:, 2] > 0.4) & (x[:, 0] == 1)).astype(float)
    cuts = [boosting.weighted_cuts(*np.unique(x[:, j], return_counts=True)) for j in range(3)]
    assert all(np.allclose(c, np.unique(np.quantile(x[:, j], np.linspace(0.05, 0.95, 19)))) for j, c in enumerate(cuts))
    bins = boosting.binned(x, cuts)
    plain = boosting.BoostedTrees(rounds=10).fit(x, y)
    parts = [(bins[:, :900], y[:900], np.ones(900)), (bins[:, 900:], y[900:], np.ones(2100))]
    summed = boosting.BoostedTrees(rounds=10).fit_cells(lambda sums: [sums(*p) for p in parts], cuts, y.mean())
    assert np.allclose(plain.predict(x), summed.predict(x))


def test_personal_data_is_learnt_from_every_span_in_any_number_of_parts(spark, monkeypatch):
    texts = [f"mail user{i}@host{i % 50}.example.com now" for i in range(4501)] + ["from 10.0.0.7 it came"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    fit, seen = boosting.BoostedTrees.fit_cells, []

    def spy(self, parts, cuts, share):
        def counted(sums):
            out = parts(sums)
            seen.append((len(out), sum(out)[:, 0, :len(cuts[0]) + 1].sum()))
            return out
        return fit(self, counted, cuts, share)

    monkeypatch.setattr(boosting.BoostedTrees, "fit_cells", spy)
    monkeypatch.setattr(pii, "BoostedTrees", functools.partial(boosting.BoostedTrees, rounds=2))
    h = spark.createDataFrame([(0, t.split()[1]) for t in texts[:-1]], "kind int, span string")
    even = h.where("xxhash64(kind, span) % 2 = 0").count()
    trees = pii.train(docs).trees
    assert seen[0] == (1, 4 * even + 6)  # the spellings of each span of the fitting half, and of the only address
    monkeypatch.setattr(pii, "CELL_ROWS", 8)
    seen.clear()
    again = pii.train(docs).trees
    assert seen[0][0] > 1 and seen[0][1] == 4 * even + 6
    x = np.random.default_rng(2).integers(0, 60, (500, len(pii.features("x", 0, 0, 1)))).astype(float)
    assert np.allclose(again.predict(x), trees.predict(x))


def test_a_few_spans_of_a_kind_fit_and_calibrate_in_turn(spark):
    spans = spark.createDataFrame([(0, f"s{i}") for i in range(7)] + [(1, "a")] + [(2, f"t{i}") for i in range(3000)], "kind int, span string")
    got = pii._halves(spans, {0: 7, 1: 1, 2: 3000}).collect()
    count = lambda k: (sum(r.fits for r in got if r.kind == k), sum(r.held for r in got if r.kind == k))
    assert count(0) == (4, 3) and count(1) == (1, 1) and sum(count(2)) == 3000 and min(count(2)) > 1300


def test_decoys_are_cut_and_weighed_by_whole_arrays():
    import math

    import numpy as np

    from salesplane.llm import secret_scan as ss
    x = np.linspace(-7, 20, 5001)
    want = np.array([math.erfc(v) for v in x])
    assert np.allclose(ss._erfc(x), want, rtol=1e-12, atol=0)
    words = ["abc", "Def", "7x", "zZ9"]
    written = {k: bytes(v).decode() for k, v in ss._written(words).items()}
    assert written == {0: "abcDef7xzZ9", 62: "AbcDef7xZZ9", 64: "abc/Def/7x/zZ9", 66: "abc-Def-7x-zZ9"}
    assert all(len(v) == 0 for v in ss._written([]).values())
    # whole pieces of 16 and a last one that ends with the text; shorter texts have none
    assert ss._piece_starts(np.array([33, 15, 0, 16, 32]), 16).tolist() == [0, 16, 17, 48, 64, 80]


def test_decoys_weigh_as_their_own_symbols_do_with_one_tail_each(monkeypatch):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("etaoinshrdluETA017", k=rng.randint(1, 9))) for _ in range(n)) for n in (0, 3, 40, 7000, 25_000)]
    monkeypatch.setattr(secret_scan, "STRETCH", 1 << 16, raising=False)  # pieces begin in one stretch and end in the next
    got, want = secret_scan.decoy_counts(texts), collections.Counter()
    for written in map(secret_scan._written, map(secret_scan._ordinary, texts)):
        for size in secret_scan.SIZES:
            symbols = secret_scan._TABLES[size][written.get(size, written[0])]
            for b, n in enumerate(secret_scan.LENGTHS):
                starts = secret_scan._piece_starts(np.array([len(symbols)]), n)
                if len(starts):
                    found = secret_scan.evidence(symbols[starts[:, None] + np.arange(n)], size)
                    want.update((size, b, int(s)) for s in secret_scan._null_step(found))
    assert got == want
    tail, weighed = secret_scan._upper_tail, []
    monkeypatch.setattr(secret_scan, "_upper_tail", lambda z: weighed.append(len(z)) or tail(z))
    assert secret_scan.decoy_counts(texts) == got
    assert sum(weighed) == sum(got.values())  # symbol counts and runs are whole numbers, whose tails are known by now


def test_texts_without_a_long_run_of_token_characters_lose_no_span():
    rng = random.Random(2)
    plain = secret_scan._HEX, secret_scan._TOKEN
    for _ in range(3000):
        text = "".join(rng.choice(["é", " ", "\U0001F600", "=", "-", "ab1" * 5, "0f" * 8, "F" * 15, "a1b2c3d4" * 4, "x"]) for _ in range(rng.randint(0, 6)))
        assert [x for x in secret_scan.base_spans(text) if x[1] == 2] == [(m.start(), 2, m.end()) for m in plain[0].finditer(text)]
        tokens = [m.span() for m in plain[1].finditer(text) if any(c in "0123456789" for c in m[0]) and any(c.isalpha() for c in m[0])]
        assert secret_scan.candidates(text, []) == tokens
        assert secret_scan._ordinary("\ud800" + text) == secret_scan._ordinary(" " + text)

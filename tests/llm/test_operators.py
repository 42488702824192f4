"""Training-data operators against brute force, round trips and held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from salesplane.llm import (decontaminate, embedding_dedup, html_text, language_id, license_scan, packing, pii, secret_scan,
                            simhash, suffix_dedup)
from salesplane.llm.boosting import BoostedTrees, calibrated_threshold
from salesplane.llm.common import min_doc_components

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOC)


def groups(n, linked):
    """Smallest index reachable from each of ``n`` through the pairs ``linked``."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name,query,sql", [("op1", decontaminate.op1, decontaminate.OP1_SQL),
                                            ("op2", license_scan.op2, license_scan.OP2_SQL)])
def test_sql(spark, name, query, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    exp = con.execute(sql).df().sort_values("doc_id").reset_index(drop=True)
    got = query(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == len(exp)
    for c in got.columns:
        assert ((got[c] == exp[c]) | (got[c].isna() & exp[c].isna())).all(), c


def test_short_benchmark_items_hit(spark):
    items = spark.createDataFrame([(7, "Alpha beta GAMMA"), (8, "one"), (9, None), (10, ""), (None, "zeta eta"), (11, "é É x1")],
                                  "item_id long, text string")
    long = " ".join(f"w{i}" for i in range(40))
    docs = docs_of(spark, ["x alpha, beta; gamma y", "one two ONE", None, "", "alpha beta", "zeta eta", long, "é É x1", "é é x1"])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.scan(docs, items).collect()}
    assert got == {0: (5, 3, 1, True), 1: (3, 2, 1, True), 2: (0, 0, 0, False), 3: (0, 0, 0, False), 4: (2, 0, 0, False),
                   5: (2, 0, 0, False), 6: (40, 0, 0, False), 7: (3, 3, 1, True), 8: (3, 0, 0, False)}


def test_windows_found_wherever_they_lie(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 2)))
    items = [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            w = rng.choice(items).split()
            a = rng.randint(0, len(w) - 1)
            parts[rng.randint(0, len(parts)):0] = w[a:a + rng.randint(1, 25)]
        texts.append(" ".join(parts))
    windows = collections.defaultdict(set)
    for i, t in enumerate(items):
        w = t.split()
        for k in range(max(1, len(w) - 12)):
            windows[tuple(w[k:k + 13])].add(i)
    got = {r["doc_id"]: r for r in decontaminate.scan(
        docs_of(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    for i, t in enumerate(texts):
        w, hit, found = t.split(), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= ids
        ids = ",".join(sorted(map(str, found)))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) == (len(w), len(hit), len(found))
        assert got[i]["items_sha256"] == hashlib.sha256(ids.encode()).hexdigest()


def test_license_inheritance(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.txt", "nothing"),
        (3, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (4, "a/b/c/d/y.txt", None), (5, "a/z.txt", ""), (6, "q/w.txt", "free text\nLicensed under the Apache License, Version 2.0.\nmore"),
        (7, None, "Released under the MIT License."), (8, None, None), (9, "top.txt", "the license of the version"), (9, "top.txt", "the license of the version"),
        (10, "ab/LICENSE-2", "unrelated")], "id long, path string, text string")
    got = collections.Counter((r["id"], r["license"], r["origin"], r["origin_path"]) for r in license_scan.scan(files).collect())
    assert got == collections.Counter({
        (1, "MIT", "file", "a/LICENSE"): 1, (2, "GPL-3.0", "directory", "a/b/COPYING"): 1, (3, "GPL-3.0", "file", "a/b/COPYING"): 1,
        (4, "GPL-3.0", "directory", "a/b/COPYING"): 1, (5, "MIT", "directory", "a/LICENSE"): 1, (6, "Apache-2.0", "header", "q/w.txt"): 1,
        (7, "MIT", "header", None): 1, (8, None, "none", None): 1, (9, None, "none", None): 2, (10, None, "none", None): 1})


L = "Lorem ipsum dolor sit amet, consectetur adipiscing elit sed do."


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("plain  text\n only", "plain text only"), ("<p>one<p>two<br>three", "one\ntwo three"),
    ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>a &amp; b&nbsp;c<!-- no --></p></article><footer>f</footer>", "T\na & b c"),
    (f"<div><a href=1>a b</a><a href=2>c d</a></div><div><p>{L}<p>{L}</div><div>Home <a href=3>about us here</a></div>", f"{L}\n{L}"),
    (f"<div id=main><div class=sidebar><p>{L}{L}</p></div><div><h2>T</h2><p>{L}</p><ul><li>x<li>y</ul></div><div class='user-comments'><p>{L}</p></div></div>",
     f"T\n{L}\nx\ny"),
    (f"<main><p>{L}</p><script>var a='<p>no</p>';</script><form><p>no</p></form><table><tr><td>1<td>2<tr><td>3</table></main>", f"{L}\n1 2\n3"),
    (f"<body><div class='cookie-notice'>{L}</div><p>{L}</p><aside>{L}</aside><div style='display: none'>{L}</div></body>", L),
])
def test_main_text(source, text):
    assert html_text.main_text(source) == text


def test_long_and_deep_pages():
    assert html_text.main_text("<div>" * 3000 + L + "</div>" * 3000) == L
    assert html_text.main_text("<p>" + L * 20000 + "</p>") == L * 20000
    assert html_text.main_text("<a title='x " + "<" * 20000).startswith("<a title")


@pytest.mark.parametrize("name", ["content has-sidebar", "with-sidebar", "no-sidebar", "no-comments", "has-cookie-notice", "hasSidebar",
                                  "layout-sidebar", "header-layout", "social"])
def test_wrappers_named_after_boilerplate_keep_the_article(name):
    side = "<div class=sidebar><p>Other words.</p></div><div class=comments>" + f"<p>{L}</p>" * 9 + "</div>"
    page = f"<body><div class='{name}'><div><p>{L}</p><p>{L}</p><p>{L}</p></div>{side}</div></body>"
    assert html_text.main_text(page) == "\n".join([L] * 3)


@pytest.mark.parametrize("quote", ["'", '"'])
def test_attribute_values_of_any_length(quote):
    uri = f"{quote}data:image/png;base64,{'iVBORw0K>Gg' * 10000}{quote}"
    page = f"<body><div class=story><div><p>{L}</p><div data-props={uri}><p>{L}</p></div><img src={uri}><p>{L}</p></div></div></body>"
    assert html_text.main_text(page) == "\n".join([L] * 3)
    for odd in ("<a " + quote, "<a " + 2 * quote, "<a ", "<a" + quote, "<a '\" "):
        html_text.main_text(odd * 50000)  # in linear time



def test_pages_are_their_articles(spark):
    import html
    for r in html_text.op3(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(40):
        b = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 200))).astype(np.uint8)
        raw = b.tobytes()
        exp = sorted(range(len(b)), key=lambda i: raw[i:])
        sa, _ = suffix_dedup.suffix_array(b)
        assert sa.tolist() == exp

        def common(x, y):
            k = 0
            while k < 40 and x + k < len(raw) and y + k < len(raw) and raw[x + k] == raw[y + k]:
                k += 1
            return k

        assert suffix_dedup.common_prefixes(b, sa, 40).tolist() == [0] + [common(x, y) for x, y in zip(exp, exp[1:])]


def removed(texts, window):
    count = collections.Counter()
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        count.update(raw[i:i + window] for i in range(len(raw) - window + 1))
    out = []
    for raw in raws:
        cover = np.zeros(len(raw), bool)
        for i in range(len(raw) - window + 1):
            if count[raw[i:i + window]] > 1:
                cover[i:i + window] = True
        runs = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(raw) else 0
        out.append((len(raw), int(cover.sum()), runs, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~cover])).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [512, 2])
def test_repeated_strings(spark, shard):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdeé") for _ in range(n))
    passages = [text(n) for n in (40, 64, 90, 200)]
    texts = [None, "", "short", "a" * 300, "ab" * 200, text(63)]
    texts += [text(rng.randint(0, 90)) + rng.choice(passages) + text(rng.randint(0, 150)) for _ in range(40)]
    texts += [texts[-1], texts[-1], texts[-2] + texts[-3]]
    got = sorted(suffix_dedup.deduplicate(docs_of(spark, texts), window=64, gram=16, shard_contexts=shard).collect())
    assert [tuple(r)[1:] for r in got] == removed(texts, 64)


def test_packing_fills_sequences(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "a b\u0085c \x1c d <|endoftext|> I'LL"),
                                   (10**6 + 3, "word " * 5000), (10**6 + 3, "word " * 5000)], "doc_id long, text string")
    both = docs.unionByName(extra)
    got = packing.pack(both, packing.tokenizer_path()).toPandas()
    exp, tokens = collections.Counter(), 0
    for r in both.collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        tokens += len(ids)
        exp.update((r["doc_id"], k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048))
    assert collections.Counter(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == exp
    got = got.sort_values(["sequence_id", "offset"])
    ends = (got["offset"] + got["length"]).groupby(got["sequence_id"])
    assert (ends.shift(1).fillna(0) == got["offset"]).all() and ends.max().max() <= 2048
    assert got["sequence_id"].nunique() <= -(-tokens // 2048) + 2


def test_fill_patterns():
    rng = random.Random(2)
    for _ in range(50):
        counts = {rng.randint(1, 50): rng.randint(1, 40) for _ in range(rng.randint(1, 20))}
        used, bins = collections.Counter(), 0
        patterns = packing.fill_patterns(counts, 50)
        for times, parts in patterns:
            assert times > 0 and sum(n * k for n, k in parts) <= 50
            used.update({n: times * k for n, k in parts})
            bins += times
        assert used == collections.Counter(counts)
        assert bins >= -(-sum(n * c for n, c in counts.items()) // 50)
        assert len(patterns) <= sum(1 + 50 / n for n in counts)


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")) or k == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)) \
                    or k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_pii_base_spans():
    rng = random.Random(1)
    texts = ["".join(rng.choice("0123456789+-. ()@a.1%é0") for _ in range(rng.randint(0, 80))) for _ in range(20000)]
    texts += ["1" * 20000, "a@" * 5000, "+1 (" * 5000, "1.2.3." * 5000, "4111 1111-1111 1111", "x.y+z@a-b.co.uk."]
    for t in texts:
        assert pii.base_spans(t) == plain_pii(t)


def test_pii_model_and_redaction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000)
    model = pii.train(docs, sample_spans=400)
    assert model is not None
    for t, kind in (("call me at (743) 555-3824 now", 3), ("please mail bob [at] example [dot] com today", 0)):
        base, more = pii.find_spans(t, model)
        assert not base and [k for k, _, _ in more] == [kind]
    for t in ("on 2021-10-12 we met", "see 12.10.2020", "pages 12 345 678", "meet (at) 5.30", "card 4111.1111.1111.1112"):
        assert pii.find_spans(t, model) == ([], [])
    text = "a bob.1@mail.example.com b 10.0.0.1 c +1 (743) 555-3824."
    assert pii.redact(text, model) == "a <EMAIL> b <IP> c <PHONE>."
    assert pii.redact("clean text", model) == "clean text" and pii.redact(None, model) is None
    row = pii.redact_documents(docs_of(spark, [text]), model).first()
    assert row["n_chars"] == len(row["text"]) and row["source"] == "s"


def test_boosting_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    p = BoostedTrees().fit(x[:400], y[:400]).predict(x[400:])
    assert ((p > 0.5) == y[400:]).mean() > 0.9
    limit = calibrated_threshold(p, y[400:], 0.95)
    assert y[400:][p >= limit].mean() >= 0.95
    assert calibrated_threshold(np.array([0.9]), np.array([0.0]), 0.5) == 2.0


def plain_simhash(text, k=3):
    import xxhash
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_values(spark):
    texts = [None, "", " \t", "One", "a b", "A B c", "a b c d a b c d", "é É x y z", "w " * 3000]
    assert [simhash.simhash(t) % 2**64 for t in texts] == [plain_simhash(t) for t in texts]
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert simhash.simhash("A b C") == row["h"]


@pytest.mark.parametrize("bucket", [4096, 20])
def test_simhash_components(spark, bucket):
    rng = random.Random(bucket)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(60)}
                 | {0} | {rng.getrandbits(64) for _ in range(50)})
    reps = spark.createDataFrame([(x - 2**64 if x >> 63 else x, i) for i, x in enumerate(fps)], "fp long, id long")
    parts = {r["node"]: r["component"] for r in min_doc_components(simhash.link_fingerprints(reps, 3, bucket)).collect()}
    exp = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert [parts.get(i, i) for i in range(len(fps))] == exp


def test_covering_masks_cover():
    masks, rng = simhash.covering_masks(3), random.Random(0)
    assert len(masks) == 15
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not diff & m for m in masks)


def test_components_on_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (300, 299)]
    got = {r["node"]: r["component"] for r in min_doc_components(spark.createDataFrame(links, "u long, v long")).collect()}
    exp = {i: 100 for i in range(101, 161)} | {i: 5 for i in range(200, 260)} | {300: 299}
    assert got == exp


def test_copies_and_frequent_kinds_leave_rare_kinds_their_sample(spark):
    rng = random.Random(6)
    cards = []
    while len(cards) < 40:
        d = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if pii.luhn(d):
            cards.append(" ".join(d[i:i + 4] for i in range(0, 16, 4)))
    texts = ["Our mail is info@copies.example.com today."] * 3000 + [f"Write to user{i}@host{i % 50}.example.com now." for i in range(3000)]
    model = pii.train(docs_of(spark, texts + [f"Paid by card {c} today." for c in cards]), sample_spans=100)
    assert model.thresholds[0] < 1 and model.thresholds[2] < 1
    alone = pii.train(docs_of(spark, [texts[0]] + texts[3000:] + [f"Paid by card {c} today." for c in cards]), sample_spans=100)
    assert model.thresholds == alone.thresholds



@pytest.mark.parametrize("sep", [", ", "\n", " ", ". "])
def test_every_address_of_a_list_is_proposed(sep):
    names = ["jane", "joe", "ann", "bob", "eve", "max", "tom", "sue", "kim", "lee"]
    for n in (2, 10):
        for form in ("{} [at] ex.com", "{}é@ex.com", "{} (at) mail (dot) org"):
            items = [form.format(x) for x in names[:n]]
            text = sep.join(items)
            found = [text[a:b] for k, a, b in pii.proposals(text, []) if k == 0]
            assert found == items, (form, n)



def test_secret_base_spans():
    rng = random.Random(1)
    parts = ["token", "PassWord", "secret", "api_key", "APIKEY", '"', "'", " ", ":", "=", "AKIA", "a1b2c3d4", "ABCD0123", "0" * 20, "deadbeef" * 3, "é", "ſecret"]
    for _ in range(20000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        keys = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
        exp = [(m.start(), 0, m.end()) for m in re.finditer(rf"({keys})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[2]) >= 8]
        exp += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        exp += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert secret_scan.base_spans(t) == sorted(exp)


def test_random_tokens_are_found_and_names_are_not(spark):
    rng = random.Random(4)
    plain = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secrets = ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(20)]
    names = ["see thisIsAnOrdinaryIdentifierNameOfSomeVariable2", "the some-long-url-path-component-of-2021-with-words"]
    texts = plain + [f"key {s} end" for s in secrets] + names
    model = secret_scan.train(docs_of(spark, texts))
    found = [secret_scan.find_spans(f"key {s} end", model)[1] for s in secrets]
    assert sum(f == [(4, 3, 64)] for f in found) >= 15
    assert not any(secret_scan.find_spans(t, model)[1] for t in plain + names)


def test_randomness_is_uniform_on_random_tokens():
    rng = np.random.default_rng(1)
    p = np.array([secret_scan.randomness(rng.integers(0, 16, 64), 16) for _ in range(2000)])
    assert 0.01 < (p < 0.05).mean() < 0.12 and 0.4 < (p > 0.5).mean() < 0.65
    assert secret_scan.randomness(np.array([0, 1] * 32), 16) < 1e-6
    assert secret_scan.randomness(np.zeros(32, int), 16) < 1e-6


def test_one_key_among_thousands_of_ordinary_tokens(spark):
    rng = random.Random(8)
    words = ["build", "release", "windows", "server", "module", "index", "packet", "number", "update", "thread", "signal", "branch"]
    prose = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(300)]
    slugs = [" ".join("-".join(rng.choice(words) for _ in range(4)) + f"-{rng.randint(1, 99)}" for _ in range(20)) for _ in range(250)]
    key = "".join(rng.choice(secret_scan.ALPHABETS[5]) for _ in range(64))
    for n in (20, 250):
        model = secret_scan.train(docs_of(spark, prose + slugs[:n] + [f"key {key} end"]))
        assert secret_scan.find_spans(f"key {key} end", model)[1] == [(4, 3, 68)], n
        assert not any(secret_scan.find_spans(t, model)[1] for t in slugs + prose)



def test_language_held_out_accuracy(spark):
    got = language_id.op9(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", F.length("text").alias("n")), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(got["doc_id"], got["held_out"]))
    test = got[got["held_out"] & (got["n"] >= 100)]
    assert (test["lang"] == test["lang_pred"]).mean() > 0.97 and test["rejected"].mean() < 0.02
    assert got["score"].between(0, 1).all()


def test_embedding_links_and_recall(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 24))
    x = np.vstack([x] + [x[i] * rng.uniform(0.5, 2) + rng.normal(size=24) * 0.12 for i in rng.integers(0, 20, 400)] + [x[3]] * 30)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 24), (n + 2, [float("nan")] + [1.0] * 23), (n + 3, [None] + [1.0] * 23), (n + 4, []), (n + 5, [float("inf")] * 24),
             (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas().sort_values("vec_id")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.95
    links = np.concatenate([hit.sum(1) - 1, [0] * 6, [1, 1]])
    assert got["n_links"].sum() >= 0.99 * links.sum() and (got["n_links"].to_numpy() <= links).all()
    exp = groups(n, zip(*np.nonzero(np.triu(hit, 1)))) + [n + i for i in range(6)] + [n + 6, n + 6]
    assert got["component_id"].tolist() == exp
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()


def test_any_number_of_language_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    stray = docs.where("text is not null").limit(1).select(F.explode(F.sequence(F.lit(10**9), F.lit(10**9 + 79))).alias("doc_id"), "text")
    many = docs.unionByName(stray.select(F.col("doc_id").cast("long"), F.lit("word another thing").alias("text"),
                                         F.concat(F.lit("x"), "doc_id").alias("lang")))
    dicts = language_id.train_dictionaries(many)
    assert len(dicts) == 80 + docs.where("length(text) > 0").select("lang").dropna().distinct().count()
    texts = [r["text"] for r in docs.limit(40).collect()]
    whole = language_id._batch_classifier(dicts, len(dicts))(texts)
    assert whole == language_id._batch_classifier(dicts, 7)(texts)
    assert [tuple(r) for r in language_id.predict_language(docs_of(spark, texts), dicts).orderBy("doc_id").select("lang_pred", "score").collect()] == whole
    assert dict(language_id.train_dictionaries(docs)).items() <= dict(dicts).items()

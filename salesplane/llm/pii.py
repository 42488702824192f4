"""Personal data: high-recall span proposals, boosted trees, calibrated redaction."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .boosting import BoostedTrees, binned, calibrated_threshold, weighted_cuts
from .common import hash_sample, read_table, staged

KINDS = ("email", "ip", "card", "phone")
#: Kinds of up to so many distinct spans are halved in order, larger ones by hash.
FEW_SPANS = 1000
#: Training rows of equal bins that one task adds up.
CELL_ROWS = 50_000
#: Scores are counted in so many equal steps.
SCORE_STEPS = 10_000
#: Precision that a kind's threshold has to reach on the held-out half.
PRECISION = 0.99
MIN_PROBABILITY = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the certain patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text)
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# High-recall generators of what the certain patterns leave: spelled-out and
# internationalised addresses, addresses in other notations, numbers with any
# separators and without a plus.  Each is tried around its anchor only: kind,
# anchor, characters before and after it, pattern.
_PROPOSALS = (
    (0, re.compile(r"[\[({<] ?at ?[\])}>]", re.I), 70, 330,
     re.compile(r"[\w.%+-]{1,64} ?[\[({<] ?at ?[\])}>] ?[\w-]{1,63}(?: ?(?:\.|[\[({<] ?dot ?[\])}>]) ?[\w-]{1,63}){1,4}", re.I)),
    (0, re.compile("@"), 70, 330, re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,4}")),
    (1, re.compile(r":[0-9a-fA-F]{1,4}:"), 5, 45,
     re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){3,7}[0-9a-fA-F]{1,4}(?![\w:])")),
    (1, re.compile(r"(?<![0-9])[0-9]"), 1, 45,
     re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:\.|[\[({] ?(?:\.|dot) ?[\])}]) ?[0-9]{1,3}){3}(?![0-9])", re.I)),
    (2, re.compile(r"(?<![0-9])[0-9]"), 1, 45, re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4}){3}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])[0-9]"), 4, 45,
     re.compile(r"(?<![\w+])(?:00[ .-]?[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}[0-9]{2,4}){2,4}(?!\w)")),
)
_WORDS = (
    ("mail", "contact", "write", "courriel", "correo", "kontakt"),
    ("ip", "host", "server", "address", "adresse"),
    ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    ("phone", "tel", "call", "fax", "mobile", "telefon", "teléfono", "téléphone"),
    ("version", "page", "date", "isbn", "order", "total", "section", "v"),
)
_DATE = re.compile(r"(?:19|20)[0-9]{2}|[0-3]?[0-9][./-][0-3]?[0-9][./-](?:[0-9]{2}){1,2}")


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping candidate spans that touch no certain one."""
    taken = np.array(sorted((a, b) for _, a, b in base) or [(0, 0)])
    taken_ends = np.maximum.accumulate(taken[:, 1])
    out, digits = [], bool(_DIGIT.search(text))
    for kind, anchor, before, after, pattern in _PROPOSALS:
        if kind and ":" not in anchor.pattern and not digits:
            continue
        done, found = 0, []
        for hit in anchor.finditer(text):
            if hit.start() < done:
                continue
            lo = max(0, hit.start() - before)
            at, window = max(0, lo - 1), text[max(0, lo - 1):hit.end() + after]
            m = pattern.search(window)
            # An earlier neighbour may come first; the span may begin inside what that one takes.
            while m and at + m.start() <= hit.start() and at + m.end() < hit.end():
                m = pattern.search(window, m.start() + 1)
            if m and at + m.start() <= hit.start():
                a, b = at + m.start(), at + m.end()
                done = b
                if found and a < found[-1][1]:
                    shorter = pattern.match(text[found[-1][0]:a])
                    if shorter:
                        found[-1] = found[-1][0], found[-1][0] + shorter.end()
                found.append((a, b))
        for a, b in found:
            i = int(np.searchsorted(taken[:, 0], b)) - 1
            if i < 0 or taken_ends[i] <= a:
                out.append((kind, a, b))
    return sorted(set(out))


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    s = text[start:end]
    digits = "".join(c for c in s if "0" <= c <= "9")
    runs = re.findall(r"[0-9]+", s)
    left, right = text[max(0, start - 40):start].lower(), text[end:end + 1]
    near = re.findall(r"[^\W\d_]+", left)[-4:]
    octets = [int(r[-4:]) for r in runs]
    return [float(v) for v in (
        *(kind == k for k in range(len(KINDS))), len(s), len(digits), len(digits) / max(1, len(s)), len(runs),
        max(map(len, runs), default=0), min(map(len, runs), default=0), max(octets, default=0), s.count("."), s.count("-"),
        s.count(" "), s.count("("), s.count(":"), "@" in s, sum(c.isalpha() for c in s), luhn(digits) if digits else 0,
        len(set(digits)), bool(_DATE.fullmatch(s)), bool(runs) and len(runs[-1]) == 4,
        left[-1:].isalnum(), right.isalnum(), *(any(w in group for w in near) for group in _WORDS))]


def _variants(kind: int, s: str, rng: random.Random) -> list[tuple[int, str, int]]:
    """(kind, surface, label): other spellings of a certain span, which are
    personal data too, and look-alikes of it, which aren't."""
    num = lambda lo, hi: str(rng.randint(lo, hi))
    if kind == 0:
        name, _, host = s.partition("@")
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", "."), ("(at)", "(dot)"), (" [at] ", ".")])
        return [(0, name + at + host.replace(".", dot), 1), (0, s.replace("e", "é", 1) if "e" in s.partition("@")[0] else s, 1),
                (0, rng.choice(["look", "meet", "arrive", "start"]) + " (at) " + num(1, 12) + ".30", 0),
                (0, num(1, 99) + "@" + num(1, 9) + "." + num(10, 99), 0)]
    if kind == 1:
        parts = s.split(".")
        return [(1, rng.choice(["[.]", "(.)", "[dot]"]).join(parts), 1), (1, " . ".join(parts), 1),
                (1, "2001:db8:" + ":".join(f"{int(p):x}" for p in parts), 1),
                (1, ".".join(parts[:3] + [num(256, 999)]), 0), (1, ". ".join(num(1, 400) for _ in range(4)), 0),
                (1, ":".join(num(10, 59) for _ in range(4)), 0)]
    digits = re.sub(r"[^0-9]", "", s)
    if kind == 2:
        d = (digits + "0" * 16)[:16]
        good = d if luhn(d) else next(d[:15] + str(c) for c in range(10) if luhn(d[:15] + str(c)))
        bad = good[:15] + str((int(good[15]) + rng.randint(1, 9)) % 10)
        sep = rng.choice([".", "/", "_", "  ", " - "[:2]])
        return [(2, sep.join(good[i:i + 4] for i in range(0, 16, 4)), 1), (2, sep.join(bad[i:i + 4] for i in range(0, 16, 4)), 0),
                (3, sep.join(good[i:i + 4] for i in range(0, 16, 4)), 0), (3, sep.join(bad[i:i + 4] for i in range(0, 16, 4)), 0),
                (3, "-".join(num(0, 99).zfill(2) for _ in range(3)), 0)]
    tail = digits[-10:].rjust(10, "5")
    area, mid, last = tail[:3], tail[3:6], tail[6:]
    return [(3, f"({area}) {mid}-{last}", 1), (3, f"{area}-{mid}-{last}", 1), (3, f"{area}.{mid}.{last}", 1),
            (3, f"00{num(1, 99)} {area} {mid} {last}", 1), (3, f"{num(1900, 2030)}-{num(10, 12)}-{num(10, 28)}", 0),
            (3, f"{num(10, 28)}.{num(10, 12)}.{num(1990, 2030)}", 0), (3, f"{num(10, 99)} {num(100, 999)} {num(100, 999)}", 0),
            (3, f"{num(10, 999)}-{num(10, 99)}-{num(10, 99)}", 0)]


@dataclass
class PiiModel:
    """Boosted trees and a probability threshold for each kind."""

    trees: BoostedTrees
    thresholds: list[float]

    def accept(self, text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The candidates at or over their kind's threshold that don't overlap a
        likelier (then longer, then earlier) one."""
        if not found:
            return []
        p = self.trees.predict(np.array([features(text, *c) for c in found]))
        ranked = sorted((-q, c[1] - c[2], c[1], c[0], c) for q, c in zip(p, found) if q >= self.thresholds[c[0]])
        kept: list[tuple[int, int, int]] = []
        for *_, c in ranked:
            if all(c[2] <= k[1] or k[2] <= c[1] for k in kept):
                kept.append(c)
        return sorted(kept)


def _halves(spans: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``spans`` with ``fits`` and ``held``: by a bit of the hash; of kinds of few spans
    every second one in the hash's order, a kind's only span both."""
    few = [k for k, n in counts.items() if n <= FEW_SPANS]
    h = F.xxhash64("kind", "span")
    many = spans.where(~F.col("kind").isin(few)).withColumn("fits", h % 2 == 0).withColumn("held", h % 2 != 0)
    i = F.row_number().over(Window.partitionBy("kind").orderBy(h, "span"))  # FEW_SPANS rows a kind
    own = F.create_map(*[F.lit(x) for k in few for x in (k, counts[k])]) if few else F.lit(None)
    own = spans.where(F.col("kind").isin(few)).select("*", (i % 2 == 1).alias("fits"), *(
        [((i % 2 == 0) | (own[F.col("kind")] == 1)).alias("held")] if few else [F.lit(True).alias("held")]))
    return many.unionByName(own)


def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            at = len(r.before)
            for kind, surface, label in _variants(r.kind, r.span, random.Random(r.key)):
                x = features(r.before + surface + r.after, kind, at, at + len(surface))
                out.append((x, label, int(r.fits), int(r.held)))
        yield pd.DataFrame(out, columns=["x", "y", "fits", "held"])


def _unpacked(pdf: pd.DataFrame, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), width).T


def _fit(rows: DataFrame) -> BoostedTrees:
    """Trees of all ``rows`` (x, y, fits: number of rows).  Rows of equal bins and class
    are one cell; only sums and value counts leave the tasks, but for up to CELL_ROWS
    cells, which the driver holds."""
    # Features are counts, flags, shares of two counts and numbers below 10,000, so values are few.
    width = len(rows.first()["x"])
    seen = (rows.where("fits > 0").select(F.posexplode("x").alias("j", "v"), "fits")
            .groupBy("j", "v").agg(F.sum("fits").alias("n")).toPandas())
    cuts = [weighted_cuts(own["v"].to_numpy(), own["n"].to_numpy()) for _, own in seen.sort_values(["j", "v"]).groupby("j")]

    @F.pandas_udf("binary")
    def bins(x: pd.Series) -> pd.Series:
        return pd.Series([r.tobytes() for r in np.ascontiguousarray(binned(np.stack(x), cuts).T)], dtype=object)

    cells = staged(rows.where("fits > 0").groupBy(bins("x").alias("bins"), "y").agg(F.sum("fits").alias("fits")))
    size = cells.agg(F.count("*").alias("n"), F.sum("fits").alias("fits"), F.sum(F.col("fits") * F.col("y")).alias("ones")).first()
    if size["n"] <= CELL_ROWS:
        own = cells.orderBy("bins", "y").toPandas()
        part = _unpacked(own, width), own["y"].to_numpy(float), own["fits"].to_numpy(float)

        def parts(sums):
            return [sums(*part)]
    else:
        dealt = staged(cells.repartition(-(-size["n"] // CELL_ROWS)))

        def parts(sums):
            def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                out = sum(sums(_unpacked(p, width), p["y"].to_numpy(float), p["fits"].to_numpy(float)) for p in batches)
                if not isinstance(out, int):
                    yield pd.DataFrame({"shape": [list(out.shape)], "sums": [out.tobytes()]})

            return [np.frombuffer(r["sums"]).reshape(r["shape"])
                    for r in dealt.mapInPandas(add, "shape array<int>, sums binary").collect()]

    return BoostedTrees().fit_cells(parts, cuts, size["ones"] / size["fits"])


def train(docs: DataFrame, sample_spans: int | None = None, precision: float = PRECISION) -> PiiModel | None:
    """Learn from ``docs`` (text): all distinct certain spans (if ``sample_spans`` is
    given, of each kind only so many, of smallest hash), each in one of its places
    rewritten to other spellings (class 1) and to look-alikes (class 0).  Half of each
    kind's spans fits the trees and the others calibrate the thresholds; a kind of a
    single span does both.  None if there is no certain span."""
    def certain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                for k, a, b in base_spans(text or ""):
                    if b - a <= 200:
                        key = hashlib.blake2b(text[max(0, a - 40):b + 40].encode(), digest_size=8).hexdigest()
                        out.append((key, k, text[max(0, a - 40):a], text[a:b], text[b:b + 10]))
            yield pd.DataFrame(out, columns=["key", "kind", "before", "span", "after"])

    place = F.struct("key", "before", "after")
    spans = staged(docs.select("text").where(F.col("text").rlike("[0-9@]"))
                   .mapInPandas(certain, "key string, kind int, before string, span string, after string")
                   .groupBy("kind", "span").agg(F.min(place).alias("place")).select("kind", "span", "place.*"))
    counts = {r["kind"]: r["count"] for r in spans.groupBy("kind").count().collect()}  # at most len(KINDS) rows
    if not counts:
        return None
    if sample_spans is not None:
        spans = staged(reduce(DataFrame.unionByName, [
            hash_sample(spans.where(F.col("kind") == k), ["kind", "span"], sample_spans, n) for k, n in counts.items()]))
        counts = {r["kind"]: r["count"] for r in spans.groupBy("kind").count().collect()}
    rows = staged(_halves(spans, counts).mapInPandas(_examples, "x array<double>, y int, fits int, held int")
                  .groupBy("x", "y").agg(F.sum("fits").alias("fits"), F.sum("held").alias("held")))
    trees = _fit(rows)

    @F.pandas_udf("int")
    def step(x: pd.Series) -> pd.Series:
        return pd.Series(np.floor(trees.predict(np.stack(x)) * SCORE_STEPS).astype("int32"))

    kind = F.array_position(F.slice("x", 1, len(KINDS)), F.lit(1.0)).cast("int") - 1  # the first features
    scored = (rows.where("held > 0").groupBy(kind.alias("kind"), step("x").alias("step"), "y")
              .agg(F.sum("held").alias("n")).collect())  # at most 2 * len(KINDS) * (SCORE_STEPS + 1) rows
    limits = []
    for k in range(len(KINDS)):
        own = np.array([(r["step"], r["y"], r["n"]) for r in scored if r["kind"] == k]).reshape(-1, 3)
        limits.append(calibrated_threshold(own[:, 0] / SCORE_STEPS, own[:, 1], precision, own[:, 2]))
    return PiiModel(trees, [max(t, MIN_PROBABILITY) for t in limits])


def find_spans(text: str | None, model: PiiModel | None) -> tuple[list, list]:
    """(certain spans, added spans) of a text."""
    base = base_spans(text or "")
    return base, model.accept(text, proposals(text, base)) if text and model else []


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def scan(docs: DataFrame, model: PiiModel | None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_email, n_ip, n_card, n_phone
    of the certain spans, base_sha256 of their list, spans (certain and added).
    Null or empty texts have none; other columns are not read."""
    @F.pandas_udf("struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base:string,spans:string>")
    def found(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            base, more = find_spans(t, model)
            kinds = [k for k, _, _ in base]
            out.append((*(kinds.count(k) for k in range(len(KINDS))), _listed(base), _listed(base + more)))
        return pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return (docs.select("doc_id", found("text").alias("f"))
            .select("doc_id", "f.n_email", "f.n_ip", "f.n_card", "f.n_phone",
                    F.sha2("f.base", 256).alias("base_sha256"), "f.spans"))


def redact(text: str | None, model: PiiModel | None) -> str | None:
    """``text`` with every span replaced by its kind in angle brackets;
    overlapping spans are one, named by the first."""
    if not text:
        return text
    base, more = find_spans(text, model)
    out, done = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in base + more):
        if a >= done:
            out += [text[done:a], f"<{KINDS[k].upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact_documents(docs: DataFrame, model: PiiModel | None) -> DataFrame:
    """``docs`` with text redacted and n_chars, if there, made its length again;
    all rows and other columns stay."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, model) for t in texts], dtype=object)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, train(docs))

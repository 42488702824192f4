"""Secrets: certain patterns, and a randomness test battery on other tokens."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

KINDS = ("assign", "access", "hex", "random")
#: Tokens of so many characters are tested; longer ones in pieces of MAX_TOKEN,
#: the last of which takes a remainder under MIN_TOKEN.
MIN_TOKEN, MAX_TOKEN = 16, 256
FALSE_DISCOVERIES = 0.01
#: Decoys that look most random, whose decline gives the p-values beyond them.
TAIL = 250
#: Decoys' statistics are counted on a logarithmic scale of so many steps a factor e.
NULL_STEPS, LEAST = 32, 1e-3
#: p-values are counted on a logarithmic scale of so many steps a decade.
STEPS = 10
LENGTHS = (16, 20, 24, 32, 48, 64, 128)
#: Symbols whose running sums are held at a time, and decoys weighed at a time.
STRETCH, ROWS = 1 << 18, 1 << 14

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+=*")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _only(letters: str) -> bytes:
    """Table for ``bytes.translate`` that turns all but the ASCII ``letters`` into spaces."""
    return bytes(c if chr(c) in letters else 32 for c in range(256))


_WORD_BYTES = _only(_DIGITS + _LOWER + _UPPER)
_TOKEN_MARKS, _HEX_MARKS = (bytes(33 if c != 32 else 32 for c in _only(x))
                            for x in (_DIGITS + _LOWER + _UPPER + "+/_-", _DIGITS + "abcdef"))
#: Encodings, the most specific first.
ALPHABETS = (_DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER + "234567", _DIGITS + _LOWER, _DIGITS + _UPPER,
             _DIGITS + _UPPER + _LOWER, _UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_",
             _UPPER + _LOWER + _DIGITS + "+/-_")
_SETS = tuple(map(frozenset, ALPHABETS))
_RANKS = tuple({c: i for i, c in enumerate(a)} for a in ALPHABETS)
SIZES = sorted({len(a) for a in ALPHABETS})


def _has_run(text: str, marks: bytes, n: int) -> bool:
    """Whether ``n`` characters in a row are among the marked ones."""
    return b"!" * n in text.encode(errors="replace").translate(marks)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the certain patterns, by start and kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if _has_run(text, _HEX_MARKS, 32):
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens with a digit and a letter that touch no certain span (``base``, by start)."""
    out, next_base, reach = [], 0, 0
    if not _has_run(text, _TOKEN_MARKS, MIN_TOKEN):
        return out
    for m in _TOKEN.finditer(text):
        while next_base < len(base) and base[next_base][0] < m.end():
            reach = max(reach, base[next_base][2])
            next_base += 1
        if reach <= m.start() and any(c in _DIGITS for c in m[0]) and any(c.isalpha() for c in m[0]):
            cuts = [m.start(), *range(m.start() + MAX_TOKEN, m.end() - MIN_TOKEN + 1, MAX_TOKEN), m.end()]
            out += zip(cuts, cuts[1:])
    return out


def encoding(token: str) -> int:
    """Index of the most specific alphabet that writes the token."""
    used = set(token.rstrip("="))
    return next(i for i, a in enumerate(_SETS) if used <= a)


#: Cody's rational approximations of erf below 0.46875, and of exp(x * x) erfc(x) up to 4
#: and beyond (Mathematics of Computation 23, 1969): numerators and denominators.
_ERF = ((1.85777706184603153e-1, 3.16112374387056560, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3),
        (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3))
_NEAR = ((2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594, 6.61191906371416295e1, 2.98635138197400131e2,
          8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
         (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
          3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3))
_FAR = ((1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2,
         6.58749161529837803e-4),
        (1.0, 2.56852019228982242, 1.87295284992346725, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3))


def _ratio(x: np.ndarray, of) -> np.ndarray:
    out = []
    for first, *others in of:
        y = np.full_like(x, first)
        for c in others:
            y *= x
            y += c
        out.append(y)
    return out[0] / out[1]


def _erfc(x: np.ndarray) -> np.ndarray:
    """``math.erfc`` of each value, to some units in the last place."""
    if len(x) < 64:
        return np.array([math.erfc(v) for v in x.tolist()])
    y = np.abs(x)
    out = np.exp(-y * y)
    out *= _ratio(np.minimum(y, 4.0), _NEAR)
    if (far := np.flatnonzero(y > 4)).size:
        v = y[far]
        w = 1 / (v * v)
        out[far] = np.exp(-v * v) * (1 / math.sqrt(math.pi) - w * _ratio(w, _FAR)) / v
    out = np.where(x < 0, 2 - out, out)
    if (small := np.flatnonzero(y <= 0.46875)).size:
        v = x[small]
        out[small] = 1 - v * _ratio(v * v, _ERF)
    return out


def _upper_tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2))


def _chi_tail(squares: np.ndarray, n: int, size: int) -> np.ndarray:
    """Pearson's chi-squared test by the sum of squared symbol counts."""
    return _upper_tail((squares * (size / n) - n - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))


def _runs_tail(n1: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    """Wald-Wolfowitz test by the symbols of the alphabet's upper half and the runs of either half."""
    n0 = n - n1
    mean = 2 * n0 * n1 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    return np.where(var > 0, 2 * _upper_tail(np.abs(runs - mean) / np.sqrt(np.where(var > 0, var, 1))), 1e-12)


def _serial_tail(total: np.ndarray, squares: np.ndarray, products: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Test of the lag-one correlation by the symbols' sum, the sum of their squares,
    that of neighbours' products, and the sum of the first and the last."""
    mean = total / n
    spread = squares - total * mean
    near = products - mean * (2 * total - ends) + (n - 1) * mean * mean
    varied = squares * n > total * total
    corr = near / np.where(varied, spread, 1)
    return np.where(varied, 2 * _upper_tail(np.abs(corr * math.sqrt(n))), 1e-12)


def _log(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-12))


@lru_cache(maxsize=128)
def _log_tails(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of ``_chi_tail`` by the squares, and of ``_runs_tail`` by n1 * (n + 1) + runs."""
    return _log(_chi_tail(np.arange(n * n + 1), n, size)), _log(_runs_tail(*np.divmod(np.arange((n + 1) ** 2), n + 1), n))


def _count_squares(rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the squared symbol counts of each of ``rows``."""
    m, n = rows.shape
    if n <= 32 and m > 100:  # n and two for each pair of equal symbols
        v, pairs = np.ascontiguousarray(rows.T), np.zeros(m, np.uint16)
        for k in range(1, n):
            pairs += np.add.reduce((v[k:] == v[:-k]).view(np.uint8), 0, dtype=np.uint8)
        return n + 2 * pairs.astype(np.int64)
    seen = np.bincount((rows + (np.arange(m) * size)[:, None]).ravel(), minlength=m * size).reshape(m, size)
    return np.einsum("ij,ij->i", seen, seen)


def evidence(values: np.ndarray, size: int) -> np.ndarray:
    """Fisher's statistic against "independent and uniform over ``size`` symbols"
    of each row of ``values``; small for random ones.

    Pearson's chi-squared statistic with its exact mean and variance, the
    Wald-Wolfowitz runs test about the alphabet's middle, and the lag-one serial
    correlation.
    """
    n = values.shape[1]
    v = values.T.astype(np.int64)
    high = v >= size / 2
    p_chi = _chi_tail(_count_squares(values, size), n, size)
    p_runs = _runs_tail(high.sum(0), 1 + (high[1:] != high[:-1]).sum(0), n)
    p_corr = _serial_tail(v.sum(0), (v * v).sum(0), (v[1:] * v[:-1]).sum(0), v[0] + v[-1], n)
    return -_log(np.array([p_chi, p_runs, p_corr])).sum(0)


class Pieces:
    """Evidence of pieces of one sequence of symbols (uint8, below ``size``), equal
    to that of their rows: what the tests add up along a piece is the difference of
    two running sums, which pieces of all lengths share."""

    def __init__(self, symbols: np.ndarray, size: int):
        s = np.arange(size)
        # Pieces of up to 255 symbols: 8 bits hold a count of them, 16 the sum of symbols below 128.
        marks = (s >= size / 2) | s << 8 | s * s << 24
        high, wide = symbols >= size / 2, symbols.astype(np.uint16)
        near = (wide[1:] * wide[:-1]).astype(np.int32) << 8 | (high[1:] != high[:-1])
        self.symbols, self.size = symbols, size
        self.marks, self.near = np.zeros(len(symbols) + 1, np.int64), np.zeros(len(symbols), np.int64)
        np.cumsum(np.take(marks, symbols), out=self.marks[1:])
        np.cumsum(near, out=self.near[1:])

    def evidence(self, starts: np.ndarray, n: int) -> np.ndarray:
        """``evidence`` of the pieces of ``n`` symbols, up to 255, that begin at ``starts``."""
        marks = self.marks[starts + n] - self.marks[starts]
        near = self.near[starts + n - 1] - self.near[starts]
        rows = np.lib.stride_tricks.sliding_window_view(self.symbols, n)[starts]
        chi, runs = _log_tails(n, self.size)
        corr = _serial_tail((marks >> 8 & 0xFFFF).astype(float), (marks >> 24).astype(float), (near >> 8).astype(float),
                            rows[:, 0].astype(float) + rows[:, -1], n)
        return -(chi[_count_squares(rows, self.size)]
                 + runs[(marks & 0xFF) * (n + 1) + 1 + (near & 0xFF)] + _log(corr))


def randomness(values: np.ndarray, size: int) -> float:
    """Combined p-value of "independent and uniform over ``size`` symbols"."""
    x = float(evidence(values[None], size)[0])
    return math.exp(-x) * (1 + x + x * x / 2)


def _length_bin(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def _null_step(x: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(x, LEAST)) * NULL_STEPS).astype(int)


#: Steps of the least and of the largest evidence.
LEAST_STEP, MOST_STEP = _null_step(np.array([0.0, -3 * math.log(1e-12) + 1])).tolist()


class Null:
    """Distribution of the decoys' evidence from its counts by step: exact down to
    the TAIL smallest, and below them the power law that these follow (Hill's
    estimate of the exponent, its lower 95 % bound)."""

    def __init__(self, counts: dict[int, int]):
        self.steps = np.array(sorted(counts))
        self.upto = np.cumsum([counts[s] for s in self.steps])
        self.total = int(self.upto[-1])
        last = min(int(np.searchsorted(self.upto, TAIL)), len(self.steps) - 1)
        self.tail, self.edge = int(self.upto[last]), (int(self.steps[last]) + 1) / NULL_STEPS
        falls = sum(counts[s] * (self.edge - s / NULL_STEPS) for s in self.steps[:last + 1])
        self.power = max(0.0, self.tail / falls * (1 - 1.645 / math.sqrt(self.tail)))

    def p_value(self, x: float) -> float:
        i = int(np.searchsorted(self.steps, _null_step(x), "right"))
        if i and self.upto[i - 1] >= self.tail:
            return (1 + int(self.upto[i - 1])) / (1 + self.total)
        below = max(0.0, self.edge - math.log(max(x, LEAST)))
        return max((1 + self.tail) / (1 + self.total) * math.exp(-self.power * below), 1e-300)


@dataclass
class SecretModel:
    """Nulls by (alphabet size, length bin), and the p-value up to which tokens
    are reported."""

    null: dict[tuple[int, int], Null]
    limit: float = 0.0

    def p_value(self, token: str) -> float:
        """Share of ordinary text in this alphabet and of this length that looks
        at least as random; 1 if there is none to compare with."""
        kind = encoding(token)
        values = np.array([_RANKS[kind][c] for c in token.rstrip("=")])
        own = self.null.get((len(ALPHABETS[kind]), _length_bin(max(MIN_TOKEN, len(values)))))
        return own.p_value(float(evidence(values[None], len(ALPHABETS[kind]))[0])) if own else 1.0

    def accept(self, text: str, found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        return [(a, 3, b) for a, b in found if self.p_value(text[a:b]) <= self.limit]


def _step(p: float) -> int:
    """The least step whose value 10^(-step / STEPS) is not below p."""
    return math.floor(-math.log10(p) * STEPS + 1e-9)


def _ordinary(text: str) -> list[str]:
    """Words (ASCII letters and digits) outside certain spans and candidates."""
    base = base_spans(text)
    at, parts = 0, []
    for a, b in sorted([(a, b) for a, _, b in base] + candidates(text, base)):
        if a > at:
            parts.append(text[at:a])
        at = max(at, b)
    parts.append(text[at:])
    return " ".join(parts).encode(errors="replace").translate(_WORD_BYTES).decode("ascii").split()


def _table(size: int) -> np.ndarray:
    """Symbol of each ASCII character where ordinary words are written in ``size`` symbols."""
    if size == 16:
        return np.arange(128, dtype=np.uint8) % 16
    alphabet = next(a for a in ALPHABETS if len(a) == size)
    rank = {c: i for i, c in enumerate(alphabet)}
    rank |= {c: rank[c.swapcase()] for c in _LOWER + _UPPER if c not in rank}
    return np.array([rank.get(chr(i), i % size) for i in range(128)], np.uint8)


_TABLES = {size: _table(size) for size in SIZES}


def _written(words: list[str]) -> dict[int, np.ndarray]:
    """Bytes of ASCII ``words`` as the alphabets of 62, 64 and 66 symbols write them, and (0) run together."""
    joined = np.frombuffer("/".join(words).encode(), np.uint8)
    apart = joined == ord("/")
    first = np.concatenate([[True], apart[:-1]]) if len(joined) else apart
    capital = joined - 32 * (first & (joined >= ord("a"))).astype(np.uint8)  # words have ASCII letters and digits only
    return {0: joined[~apart], 62: capital[~apart], 64: joined, 66: np.where(apart, np.uint8(ord("-")), joined)}


def decoy_counts(texts: Iterator[str]) -> dict[tuple[int, int, int], int]:
    """Decoys of ``texts`` by (alphabet size, length bin, step of the evidence):
    their words run together, in an alphabet of both cases with capitals, in one
    with separators joined by these.

    A text is written in every alphabet and cut, whole, into decoys of every length
    it reaches; the last of a length ends with the text and may overlap the one before."""
    writings: dict[int, list[np.ndarray]] = {}
    for text in texts:
        for key, codes in _written(_ordinary(text)).items():
            writings.setdefault(key, []).append(codes)
    out = np.zeros((len(SIZES), len(LENGTHS), MOST_STEP - LEAST_STEP + 1), np.int64)
    for key, parts in writings.items():
        codes, sizes = np.concatenate(parts), [s for s in SIZES if (s if s in writings else 0) == key]
        lengths = np.array([len(x) for x in parts])
        starts = [_piece_starts(lengths, n) for n in LENGTHS]
        for lo in range(0, len(codes), STRETCH):
            begin = [x[slice(*np.searchsorted(x, [lo, lo + STRETCH]))] - lo for x in starts]
            for size in sizes:
                pieces = Pieces(np.take(_TABLES[size], codes[lo:lo + STRETCH + LENGTHS[-1]]), size)
                for b, n in enumerate(LENGTHS):
                    for i in range(0, len(begin[b]), ROWS):
                        found = _null_step(pieces.evidence(begin[b][i:i + ROWS], n))
                        out[SIZES.index(size), b] += np.bincount(found - LEAST_STEP, minlength=out.shape[2])
    return {(SIZES[i], int(b), int(s) + LEAST_STEP): int(out[i, b, s]) for i, b, s in zip(*np.nonzero(out))}


def _piece_starts(lengths: np.ndarray, n: int) -> np.ndarray:
    """Where pieces of ``n`` begin that cover each of the texts of ``lengths`` run together;
    a text's last one ends with it, texts under ``n`` have none."""
    at = np.cumsum(lengths) - lengths
    count = np.where(lengths >= n, -(-lengths // n), 0)
    text = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return at[text] + np.minimum(nth * n, lengths[text] - n)


def train(docs: DataFrame, q: float = FALSE_DISCOVERIES) -> SecretModel | None:
    """Learn the null from decoys of all texts of ``docs`` (text), then the
    Benjamini-Hochberg limit from the p-values of every candidate in all texts.

    Decoys are pieces of ordinary text written in each alphabet, so short tokens,
    on which the tests have little power, need more evidence than long ones.  The
    p-values go on below one over the number of decoys, so a lone key among any
    number of ordinary tokens can pass.  None if there is no text to learn from.
    """
    def decoys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                found = decoy_counts(pdf["text"][at:at + 1000])
                yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["size", "bin", "step", "n"])

    # At most SIZES * LENGTHS * NULL_STEPS * ln(83 / LEAST) rows.
    counted = (docs.select("text").where("text is not null").mapInPandas(decoys, "size int, bin int, step int, n long")
               .groupBy("size", "bin", "step").agg(F.sum("n").alias("n")).collect())
    counts: dict[tuple[int, int], dict[int, int]] = {}
    for r in counted:
        counts.setdefault((r["size"], r["bin"]), {})[r["step"]] = r["n"]
    if not counts:
        return None
    model = SecretModel({k: Null(c) for k, c in counts.items()})

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [_step(model.p_value(t[a:b])) for t in pdf["text"] for a, b in candidates(t, base_spans(t))]
            yield pd.DataFrame({"step": found}, dtype="int32")

    counts = (docs.select("text").where("text is not null").mapInPandas(steps, "step int")
              .groupBy("step").count().collect())  # at most STEPS * 300 + 1 rows
    total, seen = sum(r["count"] for r in counts), 0
    for r in sorted(counts, key=lambda r: -r["step"]):
        seen += r["count"]
        p = 10 ** (-r["step"] / STEPS)
        if p * total <= q * seen:
            model.limit = p
    return model


def find_spans(text: str | None, model: SecretModel | None) -> tuple[list, list]:
    """(certain spans, added spans) of a text as (start, kind, end)."""
    base = base_spans(text or "")
    return base, model.accept(text, candidates(text, base)) if text and model else []


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, model: SecretModel | None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_assign, n_access, n_hex of the
    certain spans, base_sha256 of their list, spans (certain and added).  Null or
    empty texts have none; other columns are not read."""
    @F.pandas_udf("struct<n_assign:long,n_access:long,n_hex:long,base:string,spans:string>")
    def found(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            base, more = find_spans(t, model)
            kinds = [k for _, k, _ in base]
            out.append((kinds.count(0), kinds.count(1), kinds.count(2), _listed(base), _listed(base + more)))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return (docs.select("doc_id", found("text").alias("f"))
            .select("doc_id", "f.n_assign", "f.n_access", "f.n_hex", F.sha2("f.base", 256).alias("base_sha256"), "f.spans"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, train(docs))

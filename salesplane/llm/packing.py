"""Best-fit sequence packing by minimum bin slack over the length histogram."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, staged

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Text parts whose ids a task remembers; beyond that it starts anew.
CACHE_PARTS = 1 << 19
#: Rows ranked together in one window group.
RANK_ROWS = 1_000

# The vocabulary's normalizer composes and lower-cases characters and turns white
# space into spaces; its pre-tokenizer drops these and then cuts between letters
# and other characters, but for contractions and special tokens.  So a text's
# ids are those of its parts in turn: white-space-separated ones always, runs of
# letters and of other characters in plain texts (Latin-1 without apostrophe, bar
# and letter-like signs), which lower() treats as the normalizer does.
_PART = re.compile(r"[^ \t\n\r]+")
_PLAIN = re.compile(r"[\x00-&(-{}-\xa9\xab-\xb4\xb6-\xb9\xbb-\xff]*+")
_PLAIN_PART = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|[^ \t\n\ra-z\xdf-\xf6\xf8-\xff]+")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the characters from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in kept)}


def _encoder(path: str):
    """text -> its ids as little-endian unsigned 32-bit integers."""
    from tokenizers import Tokenizer

    tok, letters = Tokenizer.from_file(path), _byte_letters()
    model = tok.model

    class Ids(dict):
        def __missing__(self, part: str) -> bytes:
            if _PLAIN_PART.fullmatch(part) and part.isalpha() and part == part.lower():  # one pre-token as it is
                word = part if part.isascii() else part.encode().decode("latin-1").translate(letters)
                ids = [t.id for t in model.tokenize(word)]
            else:
                ids = tok.encode(part, add_special_tokens=False).ids
            self[part] = out = np.array(ids, "<u4").tobytes()
            return out

    known = Ids()

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if len(known) > CACHE_PARTS:
            known.clear()
        parts = _PLAIN_PART.findall(text.lower()) if _PLAIN.fullmatch(text) else _PART.findall(text)
        return b"".join(map(known.__getitem__, parts))

    return encode


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every row's ids and END_ID, cut
    only where they exceed ``capacity``.  Null text is empty: END_ID alone."""
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(path)
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"]):
                raw = encode(text) + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at:at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            rows = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield rows.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``;
    longer lengths first.  Bit s of ``reach`` says that some multiset of the
    lengths seen so far sums to s."""
    reach, steps = 1, []
    full, target = (1 << (room + 1)) - 1, 1 << room
    for n in sorted((n for n in counts if n <= room), reverse=True):
        before, left, k = reach, min(counts[n], room // n), 1
        while left:
            k = min(k, left)
            reach |= (reach << k * n) & full
            left -= k
            k *= 2
        if reach != before:
            steps.append((n, before))
        if reach & target:
            break
    best, chosen = reach.bit_length() - 1, {}
    for n, before in reversed(steps):
        k = 0
        while not before >> (best - k * n) & 1:
            k += 1
        if k:
            chosen[n] = k
            best -= k * n
    return chosen


def fill_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum bin slack: (times, [(length, copies), ...]) patterns that use up
    ``counts`` (length -> pieces).  Each bin takes the longest length left and
    the fullest combination that fits beside it; the bin is repeated while its
    pieces last.  A pattern leaves some length with fewer than its copies, so
    there are at most sum(1 + capacity / length) of them, whatever the input."""
    left, out = {n: c for n, c in counts.items() if c}, []
    while left:
        top = max(left)
        left[top] -= 1
        chosen = _fullest({n: c for n, c in left.items() if c}, capacity - top)
        left[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
        out.append((times, sorted(chosen.items(), reverse=True)))
    return out


def _places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> (first rank, copies, first sequence, first offset) per pattern."""
    ranks, rows, seq = defaultdict(int), defaultdict(list), 0
    for times, parts in patterns:
        offset = 0
        for n, k in parts:
            rows[n].append((ranks[n], k, seq, offset))
            ranks[n] += times * k
            offset += n * k
        seq += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*r)) for n, r in rows.items()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack every row of ``docs`` (doc_id, text) into sequences of ``capacity``
    ids at most: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only the histogram of lengths (``capacity`` rows at most) reaches the
    driver, which plans fill patterns for it; pieces are ranked within their
    length, in salted groups, and a rank's place follows from the patterns.
    Null or empty texts are one piece of END_ID.  Repeated rows are packed each;
    an empty table gives no rows; other columns are not read.
    """
    pieces = staged(token_pieces(docs, path, capacity))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = _places(fill_patterns(counts, capacity))

    salts = pieces.sparkSession.createDataFrame(
        [(n, -(-c // RANK_ROWS)) for n, c in counts.items()], "length long, salts long")
    salted = (pieces.join(F.broadcast(salts), "length")
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts")))
    before = (salted.groupBy("length", "salt").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
              .drop("count"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(order) - 1).join(before, ["length", "salt"])
              .withColumn("rank", F.col("rank") + F.col("before")))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for n, at in length.groupby(length.to_numpy()).indices.items():
            first, copies, first_seq, first_off = places[n]
            r = rank.to_numpy()[at]
            p = np.searchsorted(first, r, side="right") - 1
            b, slot = np.divmod(r - first[p], copies[p])
            seq[at], off[at] = first_seq[p] + b, first_off[p] + slot * n
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return (ranked.withColumn("at", place("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"))


def op5(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), path or tokenizer_path())

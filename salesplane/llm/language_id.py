"""Language identification by compression with per-language zstd dictionaries."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _HASH_SPACE, if_small, read_table, staged

#: Bound of the training sample: rows taken per language and dictionary bytes.
SAMPLE_ROWS = 400
DICT_BYTES = 1 << 16
#: Texts are encoded in blocks of so many bytes, so that the dictionary, not the
#: text's own beginning, stays what a block is compressed with.
BLOCK = 4096
#: Languages whose coders a task holds at a time.
GROUP_LANGS = 64
#: A prediction is rejected when the best and second-best sizes differ by less.
MIN_MARGIN = 0.002
UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
# Number signs such as the superscript two are word characters, not letters.  Classes with a
# character beyond 16 bits are searched range by range, the others by a table.
_NUMBER_SIGNS = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
_SIGNS = re.compile("[" + "".join(c for c in _NUMBER_SIGNS if c <= "\uffff") + "]")
_FAR = re.compile("[\U00010000-\U0010ffff]")
_FAR_SIGNS = re.compile("[" + "".join(c for c in _NUMBER_SIGNS if c > "\uffff") + "]")


def letters(text: str) -> bytes:
    """Lower-cased runs of letters, one space between them, as UTF-8."""
    text = text.lower()
    if not text.isascii():
        text = _SIGNS.sub(" ", text)
        if _FAR.search(text):
            text = _FAR_SIGNS.sub(" ", text)
    return _NOT_LETTERS.sub(" ", text).strip().encode("utf-8", "replace")


def train_dictionaries(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS,
                       dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """(language, raw-content dictionary) from ``labelled`` (doc_id, text, lang),
    most frequent language first, ties by name.

    Per language the ``sample_rows`` rows of smallest doc_id hash are read, in
    that order; the letters of their texts fill a dictionary of at most
    ``dict_bytes``.  Rows with null or empty text or null lang are not used.
    Every label gets a dictionary, however many there are.
    """
    ok = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    ids = ok.select("doc_id", "lang")
    counts = sorted(((r["count"], r["lang"]) for r in ids.groupBy("lang").count().collect()), key=lambda x: (-x[0], x[1]))
    if not counts:
        return []
    # As hash_sample: rows beyond a hash that some four times as many fall under
    # are dropped first, so no language's window grows with the input.
    h = F.pmod(F.xxhash64("doc_id"), F.lit(_HASH_SPACE))
    limits = labelled.sparkSession.createDataFrame(
        [(lang, int(min(1, (4 * sample_rows + 100) / n) * _HASH_SPACE)) for n, lang in counts], "lang string, below long")
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = staged(ids.withColumn("h", h).join(if_small(limits), "lang").where("h < below")
                    .withColumn("i", F.row_number().over(first)).where(F.col("i") <= sample_rows).select("doc_id").distinct())
    texts = (ok.select("doc_id", "lang", "text").join(if_small(picked), "doc_id", "left_semi")
             .select("lang", F.xxhash64("doc_id").alias("h"), "doc_id", F.substring("text", 1, dict_bytes).alias("text")))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [letters(t) for t in pdf.sort_values(["h", "doc_id"], kind="stable")["text"]]
        return pd.DataFrame({"lang": pdf["lang"][:1], "raw": [b" ".join(own)[:dict_bytes]]})

    raws = {r["lang"]: bytes(r["raw"]) for r in texts.groupBy("lang").applyInPandas(fill, "lang string, raw binary").collect()}
    out = [(lang, raws.get(lang, b"")) for _, lang in counts]
    return [(lang, raw) for lang, raw in out if len(raw) >= 8]


def _coder(raw: bytes) -> zstandard.ZstdCompressor:
    """Greedy parsing with 4-byte matches and one hash slot per dictionary byte:
    short matches are what tells languages apart in short texts."""
    params = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=16, hash_log=16, search_log=3, min_match=4, target_length=16,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False)
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params)


def _batch_classifier(dictionaries: list[tuple[str, bytes]], group: int = GROUP_LANGS):
    """Function from texts to their (language, score).  Coders are made for
    ``group`` languages at a time; the two smallest sizes are kept across groups."""
    groups = [range(i, min(i + group, len(dictionaries))) for i in range(0, len(dictionaries), group)]

    def coders(ranks: range) -> list[tuple[int, zstandard.ZstdCompressor]]:
        return [(rank, _coder(dictionaries[rank][1])) for rank in ranks]

    only = coders(groups[0]) if len(groups) == 1 else None

    def best(texts: list[str | None]) -> list[tuple[str, float]]:
        raws = [letters(t) if t else b"" for t in texts]
        least: list[list[tuple[int, int]]] = [[] for _ in raws]
        for ranks in groups:
            own = only or coders(ranks)
            for i, raw in enumerate(raws):
                if raw:
                    blocks = [raw[k:k + BLOCK] for k in range(0, len(raw), BLOCK)]
                    least[i] = sorted(least[i] + [(sum(len(c.compress(b)) for b in blocks), rank) for rank, c in own])[:2]
        return [(UNDETERMINED, 0.0) if not x else
                (dictionaries[x[0][1]][0], 1.0 - x[0][0] / x[1][0] if len(x) > 1 else 1.0) for x in least]

    return best


def _classifier(dictionaries: list[tuple[str, bytes]]):
    best = _batch_classifier(dictionaries)
    return lambda text: best([text])[0]


def _guess(dictionaries: list[tuple[str, bytes]]):
    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        best = _batch_classifier(dictionaries)
        for s in texts:
            yield pd.DataFrame(best(list(s)), columns=["lang_pred", "score"])

    return guess


def predict_language(docs: DataFrame, dictionaries: list[tuple[str, bytes]],
                     min_margin: float = MIN_MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of ``docs`` (doc_id, text).

    Each whole text's letters are compressed, block by block, against every
    language's dictionaries; the smallest size wins, ties go to the more frequent
    language.  ``score`` is one minus best size over second-best size.
    ``rejected`` is true for ``und`` (null text or no letter, score 0, or nothing
    was learned) and for margins under ``min_margin``.  The dictionaries are
    DICT_BYTES at most for each language.  Repeated rows stay; other columns are not
    read.
    """
    return (docs.select("doc_id", _guess(dictionaries)("text").alias("g")).select("doc_id", "g.lang_pred", "g.score")
            .withColumn("rejected", (F.col("lang_pred") == UNDETERMINED) | (F.col("score") < min_margin)))


def keep_identified(docs: DataFrame, dictionaries: list[tuple[str, bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` that predict_language doesn't reject, all columns kept."""
    g = F.col("__guess")
    return (docs.withColumn("__guess", _guess(dictionaries)("text"))
            .where((g["lang_pred"] != UNDETERMINED) & (g["score"] >= min_margin)).drop("__guess"))


def held_out() -> "F.Column":
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Dictionaries from the rows of ``docs`` that are not held out."""
    return train_dictionaries(docs.where(~held_out()))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return (predict_language(docs, learn(docs))
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected"))

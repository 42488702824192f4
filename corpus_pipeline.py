"""Corpus cleaning pipeline: each stage is one operator of ``salesplane.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesplane.llm import decontaminate, language_id, packing, pii, simhash
from salesplane.llm.common import read_table, staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told (no letters, narrow margin)."""
    return language_id.keep_identified(docs, language_id.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest doc_id of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold passages of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; every document stays."""
    return pii.redact_documents(docs, pii.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the pieces of all documents and their places."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; every stage is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language ID, SimHash and packing can't be written in SQL; tests hold the
#: pipeline against brute force.
ORACLE_SQL = None

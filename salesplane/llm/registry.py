"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    embedding_dedup,
    hard_negatives,
    html_text,
    language_id,
    license_scan,
    packing,
    pii,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": decontaminate.op1,
    "op2_license_scan": license_scan.op2,
    "op3_html_text": html_text.op3,
    "op4_suffix_dedup": suffix_dedup.op4,
    "op5_packing": packing.op5,
    "op6_pii": pii.op6,
    "op7_simhash_dedup": simhash.op7,
    "op8_secret_scan": secret_scan.op8,
    "op9_language_id": language_id.op9,
    "op10_embedding_dedup": embedding_dedup.op10,
    "op11_hard_negatives": hard_negatives.op11,
    "op12_substring_dedup": substring_dedup.op12,
    "op13_spelling_variants": spelling.op13,
}

ORACLES: dict[str, str] = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op2_license_scan": license_scan.OP2_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_substring_dedup": substring_dedup.OP12_SQL,
}

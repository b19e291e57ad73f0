"""The registered queries of the operators in this subpackage, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dealtide.llm import (
    byte_bpe,
    conversation_trie,
    language_id,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    topk,
    toxicity,
    url_filter,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.query,
    "op2_simhash": simhash.query,
    "op3_url_filter": url_filter.query,
    "op4_language_id": language_id.query,
    "op5_topk": topk.query,
    "op6_byte_bpe": byte_bpe.query,
    "op7_quality_rules": quality_rules.query,
    "op8_quality_classifier": quality_classifier.query,
    "op9_line_dedup": line_dedup.query,
    "op10_toxicity": toxicity.query,
    "op11_substring_dedup": substring_dedup.query,
    "op12_conversation_trie": conversation_trie.query,
    "op13_vector_codes": vector_codes.query,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_filter.SQL,
    "op5_topk": topk.SQL,
    "op11_substring_dedup": substring_dedup.SQL,
    "op12_conversation_trie": conversation_trie.SQL,
    "op13_vector_codes": vector_codes.SQL,
}

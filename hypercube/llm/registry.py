"""Queries of the training-data operators, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hypercube.llm import (
    chat,
    html_text,
    language,
    line_dedup,
    mixing,
    packing,
    parsing,
    prefix_trie,
    repair,
    sharding,
    simhash,
    topk,
    url_filter,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mixing": mixing.op1_source_mixing,
        "op2_exact_top_k": topk.op2_exact_top_k,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_html_extraction": html_text.op4_html_extraction,
        "op5_packing": packing.op5_packing,
        "op6_language_id": language.op6_language_id,
        "op7_document_fingerprints": parsing.op7_document_fingerprints,
        "op8_chat_prefix_tree": chat.op8_chat_prefix_tree,
        "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
        "op10_url_filter": url_filter.op10_url_filter,
        "op11_conversation_repair": repair.op11_conversation_repair,
        "op12_sharding": sharding.op12_sharding,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_source_mixing": mixing.ORACLE,
        "op2_exact_top_k": topk.ORACLE,
        "op3_line_dedup": line_dedup.ORACLE,
        "op10_url_filter": url_filter.ORACLE,
    }

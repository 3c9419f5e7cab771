"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    audit,
    embeddings,
    mixing,
    near,
    negatives,
    packing,
    pii,
    quality,
    sql,
    substring,
    suffixes,
    tokenstore,
    toxicity,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring.op1,
    "op2_toxicity": toxicity.op2,
    "op3_minhash_near_dedup": near.op3,
    "op4_url_filters": urls.op4,
    "op5_packing": packing.op5,
    "op6_suffix_dedup": suffixes.op6,
    "op7_embedding_near_dedup": embeddings.op7,
    "op8_pii": pii.op8,
    "op9_mixing": mixing.op9,
    "op10_quality_rules": quality.op10,
    "op11_token_ids": tokenstore.op11,
    "op12_hard_negatives": negatives.op12,
    "op13_filter_audit": audit.op13,
}

# the others are fitted models, token ids, packings and samples: they are tested by brute force and on held-out rows
ORACLES: dict[str, str] = {
    "op1_substring_dedup": sql.SUBSTRING,
    "op3_minhash_near_dedup": sql.NEAR,
    "op4_url_filters": sql.urls(
        urls.ORDER, urls.MIN_COUNT, urls.PRIOR, urls.ALPHABET, urls.BINS, urls.SPAN, urls.RULES
    ),
    "op6_suffix_dedup": sql.SUFFIXES,
    "op7_embedding_near_dedup": sql.EMBEDDINGS,
    "op12_hard_negatives": sql.NEGATIVES,
    "op13_filter_audit": sql.AUDIT,
}

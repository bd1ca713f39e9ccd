"""Registered queries of this package: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsekit.llm.binary_packing import binary_packing
from pulsekit.llm.bpe import bpe_digests
from pulsekit.llm.chat import perspective_rotation
from pulsekit.llm.common import table
from pulsekit.llm.conversation_repair import repair_conversations
from pulsekit.llm.filter_audit import filter_audit
from pulsekit.llm.hnsw import nearest_neighbours
from pulsekit.llm.html_extract import extract_main_text
from pulsekit.llm.ngram_jaccard import ngram_jaccard_components
from pulsekit.llm.packing import best_fit_packing
from pulsekit.llm.pii import pii_digests
from pulsekit.llm.quality_rules import quality_rules
from pulsekit.llm.secret_scan import secret_scan
from pulsekit.llm.url_filter import url_filter

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspective_rotation(table(spark, sf_dir, "conversations"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).drop("score")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digests(table(spark, sf_dir, "documents"))


def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_packing(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_ngram_jaccard, op2_quality_rules, op3_best_fit_packing, op4_bpe, op5_html_extraction, op6_secret_scan,
        op7_perspective_rotation, op8_url_filter, op9_pii, op10_hnsw, op11_filter_audit, op12_binary_packing,
        op13_conversation_repair)}

"""One query per operator over its whole table; ``SQL`` has the DuckDB form where there is one."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.llm import (
    bpe, divergence, filter_audit, html, licenses, lm, mixing, neighbours, quality_rules, sentence_pieces, simhash, sql, substring_dedup, suffix_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizers.path("word_bpe_49k.json"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.verdict(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizers.path("byte_bpe_50k.tiktoken")
    return lm.scores(_table(spark, sf_dir, "documents"), ranks, tokenizers.PATTERN)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(_table(spark, sf_dir, "documents"), tokenizers.path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_ALL = (
    op1_license_scan, op2_bpe, op3_neighbours, op4_quality_rules, op5_substring_dedup, op6_html_text, op7_simhash,
    op8_lm_scores, op9_source_mixing, op10_suffix_dedup, op11_source_divergence,
    op12_sentence_pieces, op13_filter_audit,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {
    "op4_quality_rules": sql.QUALITY.format(docs="documents"),
    "op11_source_divergence": sql.DIVERGENCE.format(docs="documents"),
    "op13_filter_audit": sql.AUDIT.format(docs="documents", labels="labels"),
    "op9_source_mixing": sql.MIXING.format(docs="documents"),
}

"""The training-data pipeline: documents in, digests of the tokens of what is kept and mixed out.

Each stage is (name, function); the function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the last keep the columns of
documents. An empty table passes through all stages; the operators state what they do with NULLs.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from saleslake.llm import bpe, mixing, quality_rules, simhash, substring_dedup
from saleslake.llm.common import written

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet every quality rule."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word passages that a document with a smaller id has."""
    return substring_dedup.cut(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return bpe.round_trip(docs, tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("source mixing", mix),
    ("BPE encoding", encode),
]
#: SQL cannot express the fingerprints and the tokens; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs

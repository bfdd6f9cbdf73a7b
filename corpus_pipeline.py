"""Documents to training tokens: quality rules, exact dedup, near-dedup, mixing, byte-level BPE."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from millrace.llm import bpe, exact_dedup, mixing, near_dup, quality  # noqa: E402
from millrace.llm.common import settings  # noqa: E402
from millrace.session import fresh_path  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that failed."""
    settings(spark)
    return quality.clean(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    settings(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity (five words, 0.8) the one with the smallest id."""
    settings(spark)
    return near_dup.drop_near_copies(docs, k=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target wants it."""
    settings(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and copy: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    settings(spark)
    return bpe.digests(docs, VOCABULARY, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]
# The sampling and the tokens can't be expressed in SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The operators' queries over the driver tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    chat,
    exact_dedup,
    hard_negatives,
    language,
    mixing,
    near_dup,
    packing,
    prefix_trie,
    quality,
    substring,
    url_filter,
    warc,
)
from millrace.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recover(table(spark, sf_dir, "conversations"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_groups(table(spark, sf_dir, "documents"), k=4).withColumnRenamed("id", "doc_id")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, VOCABULARY, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_folds(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept"]
    return judged.select("doc_id", *[F.col(f"quality.{name}") for name in fields])


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return packing.digests(packed).withColumnRenamed("id", "doc_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integers(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_chat": op2_chat,
    "op3_warc": op3_warc,
    "op4_near_dup": op4_near_dup,
    "op5_substring": op5_substring,
    "op6_bpe": op6_bpe,
    "op7_url_filter": op7_url_filter,
    "op8_language": op8_language,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}
SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op3_warc": warc.SQL,
    "op7_url_filter": url_filter.SQL,
    "op9_mixing": mixing.SQL,
    "op10_quality": quality.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}

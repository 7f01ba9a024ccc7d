"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import chat, decontaminate, licences, mixing, neardup, sharding, token_counts, topk, toxicity, warc
from quarry.session import table

#: The vocabulary file of op1; another one's path can be set here or passed on.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.digest(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_top_k": op4_top_k,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_chat_format": op6_chat_format,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_licences": op9_licences,
    "op10_sharding": op10_sharding,
}

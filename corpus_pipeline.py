"""A corpus from raw documents to shards: five stages, each one of the operators.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
output is written as Parquet and read back as the next one's input. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, mixing, neardup, sharding, toxicity
from quarry.session import drop_scratch, materialise, scratch_mark, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5; it learns from ``labels``."""
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, 0.8 or more."""
    return neardup.unique_rows(docs, width=5, percent=80)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target weights."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for each document of the mix, repeats included."""
    return sharding.digest(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("mixing", mix),
    ("sharding", shard),
]

#: The trained model and the sketches can't be expressed in SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's own scratch, and its input, are deleted once its output is
    written; what the last stage has written its lazy result still reads."""
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_scratch(spark, mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)

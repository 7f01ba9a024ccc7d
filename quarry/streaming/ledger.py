"""Append-only ledgers as streams: late rows bounded, repeated deliveries harmless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.sources import sinks


def ledger_stream(spark: SparkSession, folder: str, schema, files_a_batch: int = 100) -> DataFrame:
    """New files of a JSON-lines ledger; a corrupt line fails the batch."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").option("maxFilesPerTrigger", files_a_batch).json(folder)


def append_once(rows: DataFrame, target: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to a Parquet ledger, each key once.

    A batch anti-joins what the ledger has, so a batch that is delivered again after a
    failure adds nothing.
    """

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        known = spark.read.schema(df.schema).parquet(target) if sinks._fs(spark, target)[0].exists(sinks._fs(spark, target)[1]) else spark.createDataFrame([], df.schema)
        sinks.new_ledger_rows(known, df, keys).write.mode("append").parquet(target)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Distinct events counted by type and window of event time; state is dropped once late."""
    once = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return once.groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))

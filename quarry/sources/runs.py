"""Starting runs and pages: small files written once, never over something else."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import structure
from quarry.sources import jsonl, sinks


def write_text(spark: SparkSession, path: str, text: str, force: bool = False) -> None:
    """One small file through the store that Spark uses; refuses to replace unless forced."""
    fs, p = sinks._fs(spark, path)
    if fs.exists(p) and not force:
        raise sinks.RefusedError(f"{path} exists")
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def scaffold_page(spark: SparkSession, path: str, kind: str, title: str, stamp: str, force: bool = False) -> None:
    """A new wiki page with its front matter and a heading."""
    write_text(spark, path, sinks.front_matter_page({"type": kind, "title": title, "status": "draft", "timestamp": stamp}, f"\n# {title}\n"), force)


def web_chunks(sources: DataFrame) -> DataFrame:
    """(node_id, source_id, type, title, text, content_hash) of fetched pages (url, text)."""
    named = sources.select(X.web_source_id(F.col("url")).alias("source_id"), "text")
    return structure.markdown_chunks(named, "source_id", "text").select(F.col("chunk_id").alias("node_id"), "source_id", F.lit("section").alias("type"), "title", "text", X.short_hash(F.col("text")).alias("content_hash"))


def start_research_run(spark: SparkSession, folder: str, url: str, text: str, stamp: str) -> str:
    """Source text, chunks and manifest of one fetched page; returns the source id."""
    page = spark.createDataFrame([(url, text)], "url string, text string")
    source_id = page.select(X.web_source_id(F.col("url"))).first()[0]
    base = f"{folder.rstrip('/')}/{source_id}"
    write_text(spark, f"{base}/source.md", text)
    jsonl.write(web_chunks(page), f"{base}/chunks.jsonl", {"schema_version": "1.0"})
    write_text(spark, f"{base}/manifest.json", json.dumps({"source_id": source_id, "source_url": url, "created_at": stamp, "stages": {"fetch": {"at": stamp}}}))
    return source_id

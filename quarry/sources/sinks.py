"""Writing: the index folder, manifests, ledgers, tables and figures."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A folder without this file is never overwritten.
MARKER = "_QUARRY_INDEX"


class RefusedError(RuntimeError):
    """A write that could destroy something that isn't an index."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def build_index(spark: SparkSession, folder: str, tables: dict[str, DataFrame], protected: list[str]) -> dict[str, int]:
    """Write all tables into a new folder, then put it in the old one's place; row counts.

    Refuses the protected folders (project root, knowledge base) and a folder with content
    but no marker. The old index stays until the new one is complete.
    """
    folder = folder.rstrip("/")
    if folder in {p.rstrip("/") for p in protected}:
        raise RefusedError(f"{folder} is not a place for an index")
    fs, target = _fs(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(target) and len(fs.listStatus(target)) and not fs.exists(path(target, MARKER)):
        raise RefusedError(f"{folder} has content that is no index")
    fresh = f"{folder}.new-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{fresh}/{name}")
    counts = {name: spark.read.parquet(f"{fresh}/{name}").count() for name in tables}
    fs.create(path(f"{fresh}/{MARKER}")).close()
    # a crash in between leaves the old index beside, or the new one in place: never none
    aside = path(f"{folder}.old-{uuid.uuid4().hex}")
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, aside):
        raise OSError(f"{folder} can't be moved aside")
    if not fs.rename(path(fresh), target):
        if replaced:
            fs.rename(aside, target)
        raise OSError(f"{fresh} can't be put in place")
    if replaced:
        fs.delete(aside, True)
    return counts


def read_index(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of an index folder; none if a table is missing (degraded, not broken)."""
    fs, target = _fs(spark, folder)
    found = {s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()}
    return {name: spark.read.parquet(f"{folder}/{name}") for name in sorted(found)}


def upsert_meta(meta: DataFrame, key: str, value: str) -> DataFrame:
    """Key-value rows with one key set."""
    new = meta.sparkSession.createDataFrame([(key, value)], "key string, value string")
    return meta.where(F.col("key") != key).unionByName(new)


def merged_stage(stages: Column, name: str, fields: Column) -> Column:
    """A manifest's stages (map of maps) with one stage's fields merged in, the others kept."""
    old = F.coalesce(F.try_element_at(stages, F.lit(name)), F.create_map().cast("map<string,string>"))
    keep = F.map_filter(old, lambda k, _: ~F.map_contains_key(fields, k))
    rest = F.map_filter(stages, lambda k, _: k != name)
    return F.map_concat(rest, F.create_map(F.lit(name), F.map_concat(keep, fields)))


def appended_audit(old: Column, new: Column) -> Column:
    """Entries in first-seen order, each once."""
    return F.array_distinct(F.concat(F.coalesce(old, F.array().cast("array<string>")), new))


def new_ledger_rows(ledger: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that may be appended: unknown keys, each once. Appending them twice adds nothing."""
    return rows.dropDuplicates(keys).join(ledger.select(*keys).distinct(), keys, "left_anti")


def grid_table(cells: DataFrame) -> DataFrame:
    """(table_id, row, line): cells (table_id, row, col, text, ord) as CSV lines, the first
    non-empty text of a cell, quoted where needed."""
    anchored = cells.where("text <> ''").groupBy("table_id", "row", "col").agg(F.min_by("text", "ord").alias("text"))
    quoted = F.when(F.col("text").rlike(r'[",\n]'), F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col("text"))
    wide = cells.groupBy("table_id").agg((F.max("col") + 1).alias("width"))
    rows = anchored.withColumn("q", quoted).groupBy("table_id", "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "q"))).alias("m"))
    line = F.array_join(F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(""))), ",")
    return rows.join(wide, "table_id").select("table_id", "row", line.alias("line"))


def figure_bytes(uri: Column) -> Column:
    """Bytes of a base64 data URI; null for anything else."""
    return F.when(uri.rlike("^data:[^,]*;base64,"), F.try_to_binary(F.regexp_replace(uri, r"^data:[^,]*,", ""), F.lit("base64")))


def front_matter_page(fields: dict[str, str], body: str) -> str:
    """A markdown page with its front matter; values are JSON strings, which YAML reads alike."""
    return "---\n" + "".join(f"{k}: {json.dumps(v, ensure_ascii=False)}\n" for k, v in fields.items()) + "---\n" + body

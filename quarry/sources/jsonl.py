"""JSON lines, run folders and wiki pages as tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as X
from quarry.session import shared_dir

#: Chunk, claim, entity and relation files of a run: the fields that are read.
EVIDENCE = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType() if n in ("page", "start_char", "end_char") else T.StringType()) for n in ("node_id", "locator", "url", "quote", "page", "start_char", "end_char")]))
SCHEMAS = {
    "chunks": "node_id string, locator string, document_id string, source_id string, type string, title string, section_path array<string>, text string, content_hash string",
    "claims": T.StructType([*[T.StructField(n, T.StringType()) for n in ("claim_id", "document_id", "source_id", "claim", "claim_type", "confidence")], T.StructField("supporting_evidence", EVIDENCE)]),
    "entities": "entity_id string, name string, type string, aliases array<string>, mentions array<string>",
    "relations": "relation_id string, subject string, predicate string, object string, supporting_claim string",
}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob leads anywhere, asked of the store that Spark uses."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read(spark: SparkSession, path: str, schema, missing: str = "empty") -> DataFrame | None:
    """JSON lines with a declared schema; a corrupt line fails the read.

    ``missing``: 'empty' gives no rows for an absent file, 'none' gives None, 'raise' raises.
    """
    if missing != "raise" and not exists(spark, path):
        return None if missing == "none" else spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset_order, line): lines as text, for readers that report corrupt ones."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("offset_order"), F.col("value").alias("line")).where(F.trim("line") != "")


def judged_lines(lines: DataFrame, col: str) -> DataFrame:
    """Lines with ``corrupt``: whether one doesn't parse as JSON."""
    return lines.withColumn("corrupt", F.try_parse_json(F.col(col)).isNull())


def write(rows: DataFrame, path: str, stamp: dict[str, str] | None = None) -> None:
    """Rows as JSON lines, a stamp in front; the rows' own columns win."""
    extra = [F.lit(v).alias(k) for k, v in (stamp or {}).items() if k not in rows.columns]
    rows.select(*extra, *rows.columns).write.option("ignoreNullFields", "false").json(path)


def roundtrip(rows: DataFrame) -> DataFrame:
    """Rows written as JSON lines into the shared folder and read again with their schema."""
    path = f"{shared_dir(rows.sparkSession)}/quarry/jsonl-{uuid.uuid4().hex}"
    write(rows, path)
    return read(rows.sparkSession, path, rows.schema, "raise")


def run_files(spark: SparkSession, root: str, kind: str) -> list[str]:
    """Files of one kind in the runs under a root; a folder without claims.jsonl is no run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    globbed = lambda k: {s.getPath().getParent().toString(): s.getPath().toString() for s in path(root).getFileSystem(conf).globStatus(path(f"{root}/*/{k}.jsonl")) or []}
    runs = globbed("claims")
    return [file for folder, file in sorted(globbed(kind).items()) if folder in runs]


def run_rows(spark: SparkSession, root: str, producer: str, kind: str) -> DataFrame:
    """Rows of one kind from all runs under a root (folders with claims.jsonl), with producer,
    source id (the run's folder), and ``ord`` by folder."""
    schema = SCHEMAS[kind]
    pattern = f"{root}/*/{kind}.jsonl"
    if not exists(spark, pattern) or not run_files(spark, root, kind):
        base = spark.createDataFrame([], schema)
        return base.withColumn("producer", F.lit(producer)).withColumn("run", F.lit(None).cast("string"))
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(run_files(spark, root, kind))
    return rows.select("*", F.lit(producer).alias("producer"), run.alias("run"))


#: A field of front matter: its name, then the rest of its line and the list items under it.
_FIELD = r"(?m)^([A-Za-z_][\w-]*):[ \t]*([^\n]*(?:\n[ \t]*-[ \t][^\n]*)*)"


def front_matter(head: Column) -> Column:
    """Fields of a front matter block as a map; of a name given twice the last value stands.

    Scalars lose their quotes; lists, on one line or an item a line, become JSON arrays.
    Deeper nesting stays as written.
    """
    bare = lambda c: F.regexp_replace(F.trim(c), r"^([\"'])(.*)\1$", "$2")
    listed = lambda items: F.to_json(F.transform(F.filter(items, lambda i: F.trim(i) != ""), bare))
    value = lambda v: (
        F.when(v.rlike(r"^\s*\n[ \t]*-[ \t]"), listed(F.split(v, r"\n[ \t]*-[ \t]")))
        .when(v.rlike(r"^\[.*\]\s*$"), listed(F.split(F.regexp_replace(v, r"^\[|\]\s*$", ""), ",")))
        .otherwise(bare(v))
    )
    names = F.regexp_extract_all(head, F.lit(_FIELD), 1)
    values = F.transform(F.regexp_extract_all(head, F.lit(_FIELD), 2), value)
    last = F.filter(F.sequence(F.lit(1), F.size(names)), lambda i: ~F.array_contains(F.slice(names, i + 1, F.size(names)), F.element_at(names, i)))
    return F.when(F.size(names) > 0, F.map_from_arrays(F.transform(last, lambda i: F.element_at(names, i)), F.transform(last, lambda i: F.element_at(values, i))))


def wiki_pages(spark: SparkSession, kb: str) -> DataFrame:
    """(path, type, title, status, timestamp, body, frontmatter_json, links) of markdown pages
    with front matter and a type; links are paths from the base, those that leave it go."""
    text = F.col("value")
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(kb, wholetext=True)
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^.*?" + re.escape(kb.rstrip("/").rsplit("/", 1)[-1]) + "/", "")
    rows = raw.select(path.alias("path"), F.regexp_extract(text, r"(?s)^---\n(.*?)\n---\n", 1).alias("_head"), F.regexp_replace(text, r"(?s)^---\n.*?\n---\n", "").alias("body"))
    rows = rows.where("_head <> ''").withColumn("_fields", front_matter(F.col("_head")))
    field = lambda k: F.nullif(F.try_element_at("_fields", F.lit(k)), F.lit(""))
    written = F.regexp_extract_all("body", F.lit(r"\]\(([^)\s]+\.md)\)"), 1)
    inside = F.filter(written, lambda link: ~link.rlike("^[a-z]+:") & ~leaves_base(F.col("path"), link))
    links = F.transform(inside, lambda link: X.resolved_link(F.col("path"), link))
    return rows.select("path", *[field(k).alias(k) for k in ("type", "title", "status", "timestamp")], "body", F.to_json("_fields").alias("frontmatter_json"), links.alias("links")).where("type is not null")


def leaves_base(path: Column, link: Column) -> Column:
    """Whether a relative link climbs above the base: at some step more parts up than down."""
    parts = F.split(F.when(F.startswith(link, F.lit("/")), link).otherwise(F.concat(F.regexp_replace(path, "[^/]*$", ""), link)), "/")
    step = lambda x: F.when(x.isin("", "."), 0).when(x == "..", -1).otherwise(1)
    fold = F.aggregate(parts, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("least")), lambda a, x: F.struct((a["depth"] + step(x)).alias("depth"), F.least(a["least"], a["depth"] + step(x)).alias("least")))
    return fold["least"] < 0

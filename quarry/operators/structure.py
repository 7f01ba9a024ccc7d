"""Documents as ordered units: folding by heading, splitting, linking, section paths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISOLATED = ("table", "figure")
MOST_CHARS = 1500
#: Line ends as Python's and Unicode's line splitting have them: fixed values.
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85  ]"


def fold_sections(units: DataFrame) -> DataFrame:
    """Units (doc, ord, type, text) with their section's number from 0.

    A heading starts a section; a table or figure is one by itself and closes what came
    before; what follows it starts a section without a heading.
    """
    order = Window.partitionBy("doc").orderBy("ord")
    before = F.lag("type").over(order)
    starts = before.isNull() | F.col("type").isin("heading", *ISOLATED) | before.isin(*ISOLATED)
    return units.withColumn("section", (F.sum(starts.cast("int")).over(order) - 1).cast("int"))


def sections(units: DataFrame) -> DataFrame:
    """(doc, section, kind, n_units, first_ord, text): units joined by a blank line."""
    folded = fold_sections(units)
    rows = F.array_sort(F.collect_list(F.struct("ord", "type", "text")))
    grouped = folded.groupBy("doc", "section").agg(rows.alias("u"))
    return grouped.select("doc", "section", F.col("u")[0]["type"].alias("kind"), F.size("u").alias("n_units"), F.col("u")[0]["ord"].alias("first_ord"), F.array_join(F.transform("u", lambda x: x["text"]), "\n\n").alias("text"), F.col("u").alias("units"))


def split_long(secs: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """(doc, section, child, text): child 0 is the section; a longer one with at least two
    body units also has a child for each of them."""
    body = F.filter("units", lambda u: u["type"] != "heading")
    split = (F.length("text") > most) & (F.size(body) >= 2)
    children = F.transform(body, lambda u, i: F.struct((i + 1).alias("child"), u["text"].alias("text")))
    whole = F.array(F.struct(F.lit(0).alias("child"), F.col("text").alias("text")))
    return secs.select("doc", "section", F.explode(F.when(split, F.concat(whole, children)).otherwise(whole)).alias("n")).select("doc", "section", "n.*")


def linked_nodes(nodes: DataFrame, order: str) -> DataFrame:
    """Nodes with ids ``doc:NNN`` (three digits at least) and the ids before and after."""
    inside = Window.partitionBy("doc").orderBy(order)
    n = F.row_number().over(inside)
    width = F.greatest(F.lit(3), F.length(n.cast("string")))
    made = nodes.withColumn("node_id", F.concat(F.col("doc").cast("string"), F.lit(":"), F.lpad(n.cast("string"), width, F.lit("0"))))
    return made.withColumn("previous", F.lag("node_id").over(inside)).withColumn("next", F.lead("node_id").over(inside))


def markdown_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, chunk_id, title, text): sections of markdown, a line that starts with # heading each.

    Array functions within the row: no shuffle. Blank sections go; ids count the rest.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), LINE_END)
    base = docs.select(F.col(id_col), lines.alias("lines"))
    heads = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.startswith(F.ltrim(F.col("lines")[i]), F.lit("#")))
    base = base.withColumn("starts", F.array_union(F.array(F.lit(0)), heads))
    end = lambda i: F.coalesce(F.get("starts", i + 1), F.size("lines"))
    pieces = F.transform("starts", lambda s, i: F.slice("lines", s + 1, end(i) - s))
    kept = F.filter(pieces, lambda p: F.trim(F.array_join(p, "")) != "")
    exploded = base.select(id_col, F.posexplode(kept).alias("n", "piece"))
    is_head = F.startswith(F.ltrim(F.col("piece")[0]), F.lit("#"))
    title = F.when(is_head, F.trim(F.regexp_replace(F.col("piece")[0], r"^#+", ""))).otherwise("")
    body = F.when(is_head, F.slice("piece", 2, F.size("piece"))).otherwise(F.col("piece"))
    width = F.greatest(F.lit(2), F.length((F.col("n") + 1).cast("string")))
    return exploded.select(
        id_col,
        F.concat(F.col(id_col).cast("string"), F.lit(":c"), F.lpad((F.col("n") + 1).cast("string"), width, F.lit("0"))).alias("chunk_id"),
        title.alias("title"),
        F.regexp_replace(F.concat(title, F.lit("\n\n"), F.array_join(body, "\n")), r"^\s+|\s+$", "").alias("text"),
    )


def section_paths(units: DataFrame) -> DataFrame:
    """(doc, ord, path): labels of the headings above each unit, outermost first.

    A stack per document: a heading of depth d first pops all of depth d or more. Units are
    (doc, ord, is_heading, depth, label). They stream through in their order, so that a task
    holds one batch and one stack however long a document is. A heading without a depth pops
    all, and any heading pops it; null labels are left out of the path; a null ``is_heading``
    is no heading; units without a document form one.
    """
    names = ["doc", "ord", "is_heading", "depth", "label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run
        stack: list[tuple[int | None, str | None]] = []
        for batch in batches:
            paths = []
            for doc, is_heading, depth, label in zip(*[batch.column(c).to_pylist() for c in ("doc", "is_heading", "depth", "label")]):
                if doc != current:
                    current, stack = doc, []
                while is_heading and stack and (depth is None or stack[-1][0] is None or stack[-1][0] >= depth):
                    stack.pop()
                paths.append("/".join(x for _, x in stack if x is not None))
                if is_heading:
                    stack.append((depth, label))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("ord"), pa.array(paths, pa.string())], names=["doc", "ord", "path"])

    typed = units.select("doc", F.col("ord").cast("bigint").alias("ord"), "is_heading", F.col("depth").cast("int").alias("depth"), "label")
    schema = T.StructType([typed.schema["doc"], typed.schema["ord"], T.StructField("path", T.StringType())])
    return typed.repartition("doc").sortWithinPartitions(*names).mapInArrow(run, schema)


def batches(rows: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """Rows with the number, from 0, of their batch of ``size`` consecutive rows of a key."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("batch", F.floor((n - 1) / size))

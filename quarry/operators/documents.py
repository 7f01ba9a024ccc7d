"""Converted documents: reading order, page ranges, figures, and the run checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X

REFS = "array<struct<`$ref`:string>>"
TREE = f"struct<body:struct<children:{REFS}>,groups:array<struct<children:{REFS}>>,texts:array<struct<label:string,text:string>>,tables:array<struct<label:string>>,pictures:array<struct<label:string>>>"


def body_items(docs: DataFrame, most_levels: int = 32) -> DataFrame:
    """(doc, ord, kind, index, text) in reading order, from (doc, json) of document trees.

    References to groups unfold level by level: a row per reference with the path of its
    positions, so order is the order of paths. Trees deeper than ``most_levels`` raise.
    """
    parsed = docs.select("doc", F.from_json("json", TREE).alias("t"))
    refs = parsed.select("doc", "t", F.posexplode("t.body.children").alias("p", "r")).select("doc", "t", F.array("p").alias("path"), F.col("r")["$ref"].alias("ref"))
    done = None
    for _ in range(most_levels):
        kind, index = F.split("ref", "/")[1], F.split("ref", "/")[2].cast("int")
        typed = refs.withColumn("kind", kind).withColumn("index", index)
        leaves = typed.where("kind <> 'groups'").select("doc", "path", "kind", "index", F.when(F.col("kind") == "texts", F.get(F.col("t.texts"), F.col("index"))["text"]).alias("text"))
        done = leaves if done is None else done.unionByName(leaves)
        groups = typed.where("kind = 'groups'")
        if not groups.limit(1).count():
            return done.select("doc", F.col("path").alias("ord"), "kind", "index", "text")
        refs = groups.select("doc", "t", "path", F.posexplode(F.get(F.col("t.groups"), F.col("index"))["children"]).alias("p", "r")).select("doc", "t", F.array_append("path", F.col("p")).alias("path"), F.col("r")["$ref"].alias("ref"))
    raise ValueError(f"a document tree is deeper than {most_levels}")


def page_ranges(units: DataFrame) -> DataFrame:
    """(doc, node, page_start, page_end, unit_ids): pages may be missing, ids keep their order."""
    ids = F.array_sort(F.collect_list(F.struct("ord", "unit_id")))
    return units.groupBy("doc", "node").agg(F.min("page").alias("page_start"), F.max("page").alias("page_end"), ids.alias("u")).select("doc", "node", "page_start", "page_end", F.transform("u", lambda x: x["unit_id"]).alias("unit_ids"))


def figure_candidates(pictures: DataFrame, captions: DataFrame) -> DataFrame:
    """Pictures, then captions that no picture has, in order of page (none last)."""
    orphans = captions.join(pictures.select("doc", F.col("caption_id").alias("id")).where("id is not null"), ["doc", "id"], "left_anti")
    both = pictures.select("doc", "page", F.lit(0).alias("part"), "ord", "id", "caption").unionByName(orphans.select("doc", "page", F.lit(1).alias("part"), "ord", F.lit(None).cast("string").alias("id"), F.col("text").alias("caption")))
    place = F.struct(F.col("page").isNull().alias("n"), "page", "part", "ord")
    return both.withColumn("place", place)


def figure_nodes(figures: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each figure's node: the first figure or caption node that touches its page (if the
    figure has one) and holds its caption; null if none does."""
    f = figures.select("doc", "figure_id", "page", "caption")
    n = nodes.where(F.col("type").isin("figure", "caption")).select("doc", "node_id", "ord", "text", "page_start", "page_end")
    touches = F.col("page").isNull() | (F.col("page") == F.col("page_start")) | (F.col("page") == F.col("page_end"))
    holds = X.verbatim_ok(F.col("caption"), F.col("text"))
    matched = f.join(n, "doc", "left").groupBy("doc", "figure_id").agg(F.min_by(F.when(touches & holds, F.col("node_id")), F.when(touches & holds, F.col("ord"))).alias("node_id"))
    return f.join(matched, ["doc", "figure_id"], "left")


def check_row(name: str, failures: DataFrame | None, detail: Column) -> DataFrame | None:
    """(check, passed, detail): passed without failures; None where an input is absent."""
    if failures is None:
        return None
    return failures.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(detail)).alias("d")).select(F.lit(name).alias("check"), (F.col("n") == 0).alias("passed"), F.array_join(F.slice("d", 1, 5), "; ").alias("detail"))


def run_checks(spark, headings=None, units=None, tables=None, files=None, citations=None, pages=None, evidence=None, figures=None, texts=None) -> DataFrame:
    """The six checks of a run; a check whose inputs are absent passes as 'skipped'.

    headings/units: (text); tables/files: (table_id); citations: (page), pages: (page);
    evidence: (quote, chunk_text); figures: (figure_id, extracted, note); texts: (page, text).
    """
    checks = {
        "headings_recovered": None if headings is None or units is None else (headings.join(units.select("text").distinct(), "text", "left_anti"), F.col("text")),
        "tables_present": None if tables is None or files is None else (tables.join(files, "table_id", "left_anti"), F.col("table_id")),
        "page_citations_valid": None if citations is None or pages is None else (citations.where("page is not null").join(pages.select("page").distinct(), "page", "left_anti"), F.col("page").cast("string")),
        "evidence_quotes_verbatim": None if evidence is None else (evidence.where(~X.verbatim_ok(F.col("quote"), F.col("chunk_text"))), F.coalesce("quote", F.lit(""))),
        "figures_accounted_for": None if figures is None else (figures.where("not extracted and coalesce(note, '') = ''"), F.col("figure_id")),
        "no_ocr_garbage": None if texts is None else (texts.where(X.unprintable_share(F.col("text")) > 0.05), F.col("page").cast("string")),
    }
    out = None
    for name, given in checks.items():
        row = check_row(name, *given) if given else spark.createDataFrame([(name, True, "skipped")], "check string, passed boolean, detail string")
        out = row if out is None else out.unionByName(row)
    return out

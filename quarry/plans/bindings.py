"""The engine's relations, bound to the driver's tables; each with the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table

FIRST_SENTENCE = r"^[^.]*\."


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a claim: its first sentence is quoted from itself and from the next one."""
    d = table(spark, sf_dir, "documents")
    quote = F.regexp_extract("text", FIRST_SENTENCE, 0)

    def evidence(shift: int, q):
        at = F.concat(F.lit("d"), (F.col("doc_id") + shift).cast("string"))
        return F.struct(at.alias("node_id"), at.alias("locator"), F.concat(F.lit("http://"), "source").alias("url"), q.alias("quote"), (F.col("doc_id") % 7).cast("int").alias("page"))

    both = F.array(evidence(0, quote), evidence(1, F.when(F.col("lang") != "fr", quote)))
    return d.select(
        F.concat(F.lit("c_"), F.col("doc_id").cast("string")).alias("claim_id"),
        F.when(F.col("lang").isin("en", "de"), "pdf").otherwise("web").alias("producer"),
        F.col("source").alias("source_id"),
        F.col("text").alias("claim"),
        F.col("lang").alias("claim_type"),
        F.col("source").alias("pass"),
        F.col("doc_id").alias("ord"),
        F.when(F.col("lang") == "es", F.slice(both, 1, 0)).otherwise(both).alias("supporting_evidence"),
    )


CLAIMS_SQL = r"""
claims AS (SELECT 'c_' || doc_id AS claim_id, CASE WHEN lang IN ('en', 'de') THEN 'pdf' ELSE 'web' END AS producer, source AS source_id, text AS claim, lang AS claim_type, source AS pass, doc_id AS ord, doc_id, lang, source FROM documents),
evidence AS (SELECT claim_id, producer, source_id, pos, 'd' || (doc_id + pos) AS locator, CASE WHEN producer = 'pdf' THEN CAST(doc_id % 7 AS INTEGER) END AS page, CASE WHEN producer = 'web' THEN 'http://' || source END AS url, CASE WHEN pos = 1 AND lang = 'fr' THEN '' ELSE regexp_extract(claim, '^[^.]*\.') END AS quote FROM claims, (SELECT unnest([0, 1]) AS pos) WHERE lang <> 'es'),
chunks AS (SELECT 'd' || doc_id AS locator, text FROM documents)"""


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("locator"), "text", F.col("doc_id").alias("ord"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as mentions of their supplier under changing names."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_suppkey").cast("string").alias("entity_id"),
        F.concat("l_returnflag", "l_linestatus", F.lit("-"), F.repeat(F.lit("x"), F.col("l_linenumber").cast("int")), F.col("l_linenumber").cast("string")).alias("name"),
        F.array("l_linestatus").alias("aliases"),
        F.col("l_returnflag").alias("type"),
        F.col("l_linestatus").alias("producer"),
        F.col("l_partkey").cast("string").alias("source_id"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("ord"),
    )


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("relation_id"),
        F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("subject"),
        F.lit("flag").alias("predicate"),
        F.col("l_returnflag").alias("object"),
        F.col("l_linestatus").alias("source_id"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between regions, nations, suppliers and customers."""
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    n, s, c = (table(spark, sf_dir, t) for t in ("nation", "supplier", "customer"))
    return (
        n.select(name("n:", "n_nationkey").alias("a"), name("r:", "n_regionkey").alias("b"))
        .union(s.select(name("s:", "s_suppkey"), name("n:", "s_nationkey")))
        .union(c.select(name("c:", "c_custkey"), name("n:", "c_nationkey")))
    )


PLACES_SQL = """
edges AS (SELECT 'n:' || n_nationkey AS a, 'r:' || n_regionkey AS b FROM nation UNION ALL SELECT 's:' || s_suppkey, 'n:' || s_nationkey FROM supplier UNION ALL SELECT 'c:' || c_custkey, 'n:' || c_nationkey FROM customer),
links AS (SELECT a AS u, b AS v FROM edges UNION SELECT b, a FROM edges)"""


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, path, html): the path is the URL's, without its slashes at the ends."""
    p = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1)
    return p.select("page_id", F.regexp_replace(path, r"/+$", "").alias("path"), "html", "url")


PATHS_SQL = r"""
paths AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/+$', '') AS path, html, url FROM pages),
links AS (SELECT page_id, path, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM paths),
resolved AS (SELECT page_id, path, link, array_to_string(list_filter(string_split(CASE WHEN starts_with(link, '/') THEN link ELSE regexp_replace(path, '[^/]*$', '') || link END, '/'), lambda x: x <> '' AND x <> '.'), '/') AS target FROM links)"""


def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, path, link, target) of every link of every page."""
    from quarry.functions import text as X

    p = page_paths(spark, sf_dir).select("page_id", "path", F.explode(X.page_links(F.col("html"))).alias("link"))
    return p.withColumn("target", X.resolved_link(F.col("path"), F.col("link")))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents in reading order: users head sections, the system is a table."""
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "heading").when(F.col("role") == "system", "table").otherwise("paragraph")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("ord"), kind.alias("type"), F.coalesce("text", F.lit("")).alias("text"))


TURNS_SQL = """
turns AS (SELECT conv_id AS doc, turn AS ord, CASE role WHEN 'user' THEN 'heading' WHEN 'system' THEN 'table' ELSE 'paragraph' END AS type, coalesce(text, '') AS text FROM conversations)"""

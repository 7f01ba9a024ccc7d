"""Document, figure, verdict and record operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import adjudication as A
from quarry.operators import documents as D
from quarry.operators import structure as S
from quarry.plans import bindings as B
from quarry.plans.registry import query
from quarry.plans.structure_queries import FOLD
from quarry.session import table
from quarry.sources import runs


@query("node_page_range", FOLD + " SELECT doc, section AS node, CAST(min(ord // 2) AS BIGINT) AS page_start, CAST(max(ord // 2) AS BIGINT) AS page_end, string_agg('u' || ord, ',' ORDER BY ord) AS unit_ids FROM folded GROUP BY doc, section")
def node_page_range(spark, sf_dir):
    folded = S.fold_sections(B.turns(spark, sf_dir)).select("doc", F.col("section").alias("node"), "ord", F.floor(F.col("ord") / 2).alias("page"), F.concat(F.lit("u"), F.col("ord").cast("string")).alias("unit_id"))
    return D.page_ranges(folded).withColumn("unit_ids", F.array_join("unit_ids", ","))


@query("body_items", "SELECT conv_id AS doc, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN role = 'user' THEN 0 ELSE 1 END, turn) AS INTEGER) AS place, turn, coalesce(text, '') AS text FROM conversations")
def body_items(spark, sf_dir):
    """Each conversation as a tree: the user's turns in the body, the others in a group after them."""
    c = table(spark, sf_dir, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    ref = F.struct(F.concat(F.lit("#/texts/"), F.col("i").cast("string")).alias("$ref"))
    turns = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("u"))
    listed = turns.select("conv_id", "u", F.posexplode("u").alias("i", "x"))
    refs = listed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("x.role") == "user", F.struct("i", ref.alias("r"))))).alias("a"), F.array_sort(F.collect_list(F.when(F.col("x.role") != "user", F.struct("i", ref.alias("r"))))).alias("b"))
    only = lambda col: F.transform(col, lambda s: s["r"])
    group = F.array(F.struct(F.lit("#/groups/0").alias("$ref")))
    tree = F.struct(F.struct(F.concat(only("a"), group).alias("children")).alias("body"), F.array(F.struct(only("b").alias("children"))).alias("groups"), F.transform("u", lambda x: F.struct(x["role"].alias("label"), x["text"].alias("text"))).alias("texts"))
    docs = turns.join(refs, "conv_id").select(F.col("conv_id").alias("doc"), F.to_json(tree).alias("json"), F.transform("u", lambda x: x["turn"]).alias("turns"))
    items = D.body_items(docs.select("doc", "json"))
    from pyspark.sql import Window

    ranked = items.withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy("ord")))
    return ranked.join(docs.select("doc", "turns"), "doc").select("doc", "place", F.get("turns", F.col("index")).alias("turn"), "text")


@query("run_checks")
def run_checks(spark, sf_dir):
    """The six checks with documents as pages and benchmark items as quotes; tables are absent."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    pages = d.select(F.col("doc_id").alias("page"), "text")
    evidence = b.select(F.col("text").alias("quote"), F.col("text").alias("chunk_text"))
    return D.run_checks(spark, headings=b.select("text"), units=d.select("text"), citations=b.select(F.col("item_id").alias("page")), pages=pages, evidence=evidence, texts=pages)


@query("verdict_validation", "SELECT user_id AS key, min(event_id) AS ord, arg_min(event_type, event_id) AS verdict FROM events WHERE event_type IN ('click', 'view', 'purchase') AND value >= 20 GROUP BY user_id")
def verdict_validation(spark, sf_dir):
    """Events as replies: some verdicts aren't known, small values have a blank rationale."""
    e = table(spark, sf_dir, "events")
    own = F.array(F.col("user_id").cast("string"))
    replies = e.select(F.col("user_id").alias("key"), F.col("event_id").alias("ord"), F.col("event_type").alias("verdict"), own.alias("relation_ids"), F.when(F.col("value") >= 20, "because").otherwise(" ").alias("rationale"))
    candidates = e.select(F.col("user_id").alias("key"), own.alias("relation_ids")).distinct()
    return A.valid_verdicts(replies, candidates, ("click", "view", "purchase")).select("key", "ord", "verdict")


@query("adjudication_score", "SELECT event_type, round(avg(CASE WHEN value >= 60 THEN 1.0 WHEN value >= 30 THEN 0.5 ELSE 0.0 END), 6) AS score FROM events GROUP BY event_type")
def adjudication_score(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    given = F.when(F.col("value") >= 60, "contradiction").when(F.col("value") >= 30, "unclear").otherwise("not_contradiction")
    return e.groupBy("event_type").agg(F.round(F.avg(A.verdict_score(F.lit("contradiction"), given)), 6).alias("score"))


@query("manifest_counts", "SELECT source, count(*) FILTER (WHERE n_chars >= 600) AS accepted, count(*) FILTER (WHERE n_chars < 600) AS rejected, round(CAST(count(*) FILTER (WHERE n_chars >= 600) AS DOUBLE) / count(*), 6) AS acceptance_rate FROM documents GROUP BY source")
def manifest_counts(spark, sf_dir):
    return A.manifest_counts(table(spark, sf_dir, "documents"), "source", F.col("n_chars") >= 600)


@query("generator_digests", "SELECT coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS generator, CAST(sum(d.n_chars) AS BIGINT) AS total FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def generator_digests(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("locator"), "n_chars")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("locator"), F.col("quality").cast("string").alias("generator"))
    return A.generator_digests(d, labels, "n_chars")


@query("schema_versions", "SELECT doc_id, coalesce(nullif(lang, 'fr'), '(none)') AS declared FROM documents WHERE coalesce(nullif(lang, 'fr'), '(none)') <> 'en'")
def schema_versions(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.nullif(F.col("lang"), F.lit("fr")).alias("v"))
    return A.schema_versions(d, "v", "en").select("doc_id", "declared")


@query("web_chunks", r"SELECT * FROM (SELECT substr(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '[?#].*$', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) || '-' || substr(sha256(url), 1, 8) AS source_id, regexp_replace(html, '^\s+|\s+$', '', 'g') AS text FROM pages) WHERE text <> ''")
def web_chunks(spark, sf_dir):
    """Fetched pages as chunks; without markdown headings each page is one."""
    p = table(spark, sf_dir, "pages").select("url", F.col("html").alias("text"))
    return runs.web_chunks(p).select("source_id", "text")

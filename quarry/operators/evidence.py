"""Claims and their evidence: flattening, gates, merges, dossiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X


def flatten_evidence(claims: DataFrame) -> DataFrame:
    """A row for each item of ``supporting_evidence``, numbered from 0."""
    return claims.select("claim_id", "producer", "source_id", F.posexplode("supporting_evidence").alias("pos", "e")).select("claim_id", "producer", "source_id", "pos", "e.*")


def normalised_evidence(evidence: DataFrame) -> DataFrame:
    """PDF evidence is located by node and page, web evidence by locator and URL; no quote is ''."""
    pdf = F.col("producer") == "pdf"
    return evidence.select(
        "claim_id",
        "producer",
        "source_id",
        "pos",
        F.coalesce(F.when(pdf, F.col("node_id")).otherwise(F.col("locator")), F.lit("")).alias("locator"),
        F.when(pdf, F.col("page")).alias("page"),
        F.when(~pdf, F.col("url")).alias("url"),
        F.coalesce("quote", F.lit("")).alias("quote"),
    )


def with_chunk_text(evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """Evidence beside the text of the chunk it names; a missing chunk has the empty text."""
    named = chunks.select(F.col("locator").alias("_l"), F.col("text").alias("chunk_text"))
    return evidence.join(named, F.col("locator") == F.col("_l"), "left").drop("_l").withColumn("chunk_text", F.coalesce("chunk_text", F.lit("")))


def chunk_texts(chunks: DataFrame) -> DataFrame:
    """(locator, text): the node id if there is one, else the locator; a later duplicate wins."""
    named = chunks.select(F.coalesce(F.nullif(F.col("node_id"), F.lit("")), F.col("locator")).alias("locator"), "text", "ord")
    return named.groupBy("locator").agg(F.max_by("text", "ord").alias("text"))


def claims_check(claims: DataFrame, evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """(claim_id, producer, source_id, n_evidence, ok, reasons) of every claim."""
    judged = with_chunk_text(evidence, chunks)
    reason = F.when(F.col("quote") == "", F.concat(F.lit("empty quote: "), "locator")).when(~X.verbatim_ok(F.col("quote"), F.col("chunk_text")), F.concat(F.lit("not verbatim: "), "locator"))
    found = judged.withColumn("reason", reason).groupBy("claim_id", "producer", "source_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("pos", "reason")))).alias("bad"))
    keys = ["claim_id", "producer", "source_id"]
    joined = claims.select(*keys).join(found, keys, "left")
    reasons = F.when(F.col("n").isNull(), F.lit("no evidence")).otherwise(F.array_join(F.transform("bad", lambda b: b["reason"]), "; "))
    return joined.select(*keys, F.coalesce("n", F.lit(0)).cast("long").alias("n_evidence"), (reasons == "").alias("ok"), reasons.alias("reasons"))


def claim_gate(claims: DataFrame, evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """Claims with at least one item of evidence, all of it verbatim."""
    return claims_check(claims, evidence, chunks).where("ok").select("claim_id", "producer", "source_id")


def contradictions(relations: DataFrame) -> DataFrame:
    """Subjects and predicates with more than one object; all relation ids, distinct sources."""
    known = relations.where("subject is not null and predicate is not null and object is not null")
    return (
        known.groupBy("subject", "predicate")
        .agg(F.countDistinct("object").alias("n_objects"), F.array_sort(F.collect_set("object")).alias("objects"), F.array_sort(F.collect_list("relation_id")).alias("relation_ids"), F.array_sort(F.collect_set("source_id")).alias("sources"))
        .where("n_objects > 1")
    )


def contradiction_candidates(relations: DataFrame, pages: DataFrame) -> DataFrame:
    """(kind, subject, predicate, objects, relation_ids, sources, path): contradicting relations,
    and wiki pages whose status says that they are conflicted."""
    found = contradictions(relations).select(F.lit("relation").alias("kind"), "subject", "predicate", "objects", "relation_ids", "sources", F.lit(None).cast("string").alias("path"))
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    marked = pages.where("status = 'conflicted'").select(F.lit("conflicted_page").alias("kind"), none.alias("subject"), none.alias("predicate"), nothing.alias("objects"), nothing.alias("relation_ids"), nothing.alias("sources"), "path")
    return found.unionByName(marked)


def without_dangling(relations: DataFrame, claims: DataFrame) -> DataFrame:
    """Relations whose supporting claim is known; those that name none stay."""
    known = claims.select(F.col("claim_id").alias("_c")).distinct()
    named = F.coalesce("supporting_claim", F.lit("")) != ""
    return relations.where(~named).unionByName(relations.where(named).join(known, F.col("supporting_claim") == F.col("_c"), "left_semi"))


def spans_valid(claims: DataFrame, evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """(claim_id, valid): whether a claim has evidence, all of it a span within its chunk that
    slices to the quote. Evidence is (claim_id, locator, start_char, end_char, quote)."""
    judged = with_chunk_text(evidence, chunks).select("claim_id", F.coalesce(X.span_ok(F.col("start_char"), F.col("end_char"), F.col("chunk_text"), F.col("quote")), F.lit(False)).alias("ok"))
    per = judged.groupBy(F.col("claim_id").alias("_c")).agg(F.bool_and("ok").alias("ok"))
    return claims.select("claim_id").join(per, F.col("claim_id") == F.col("_c"), "left").select("claim_id", F.coalesce("ok", F.lit(False)).alias("valid"))


def merge_entities(rows: DataFrame) -> DataFrame:
    """One row an id: longest name (then smallest), other names and aliases, commonest type
    (then smallest), producer and source of the first row. Falsy ids go."""
    known = rows.where("entity_id is not null and entity_id <> ''")
    name = F.min(F.struct((-F.length("name")).alias("n"), "name"))["name"]
    merged = known.groupBy("entity_id").agg(
        name.alias("name"),
        F.array_distinct(F.concat(F.collect_set("name"), F.flatten(F.collect_set("aliases")))).alias("all"),
        F.mode("type", True).alias("type"),
        F.min_by("producer", "ord").alias("producer"),
        F.min_by("source_id", "ord").alias("source_id"),
    )
    return merged.select("entity_id", "name", F.array_sort(F.filter("all", lambda a: a.isNotNull() & (a != F.col("name")) & (a != ""))).alias("aliases"), "type", "producer", "source_id")


def support_union(claims: DataFrame, key: Column, min_support: int = 1) -> DataFrame:
    """Claims seen in at least ``min_support`` passes, the first of each key, in first-seen order."""
    rest = [c for c in claims.columns if c not in ("pass",)]
    keyed = claims.withColumn("_key", key)
    grouped = keyed.groupBy("_key").agg(F.countDistinct("pass").alias("support"), F.min(F.struct("ord", *[c for c in rest if c != "ord"])).alias("first"))
    return grouped.where(F.col("support") >= min_support).select("first.*", "support")


def dossier(ids: DataFrame, claims: DataFrame, evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """(pos, claim_id, status, reason, claim): ids in their order, included or rejected and why."""
    asked = ids.select("pos", F.col("claim_id").alias("_c"))
    first = claims.groupBy(F.col("claim_id").alias("_id")).agg(F.min_by("claim", F.struct("producer", "source_id")).alias("claim"))
    judged = with_chunk_text(evidence, chunks).withColumn("bad", ~X.verbatim_ok(F.col("quote"), F.col("chunk_text")))
    tallied = judged.groupBy(F.col("claim_id").alias("_e")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("bad"), F.col("locator")))).alias("bad"))
    joined = asked.join(first, F.col("_c") == F.col("_id"), "left").join(tallied, F.col("_c") == F.col("_e"), "left")
    reason = (
        F.when(F.col("_id").isNull(), F.lit("not found"))
        .when(F.col("n").isNull(), F.lit("no evidence"))
        .when(F.size("bad") > 0, F.concat(F.lit("not verbatim: "), F.array_join("bad", ", ")))
        .otherwise(F.lit(""))
    )
    return joined.select("pos", F.col("_c").alias("claim_id"), F.when(reason == "", F.lit("included")).otherwise(F.lit("rejected")).alias("status"), reason.alias("reason"), "claim")


def render_dossier(rows: DataFrame) -> DataFrame:
    """One row of markdown: the included claims numbered in order, then how many are left out."""
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("pos"))
    lines = rows.where("status = 'included'").select("pos", F.concat(number.cast("string"), F.lit(". "), "claim", F.lit(" [claim:"), "claim_id", F.lit("]")).alias("line"))
    body = lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("body"))
    left_out = rows.agg(F.sum(F.when(F.col("status") == "rejected", 1).otherwise(0)).alias("omitted"))
    return body.crossJoin(left_out).select(F.concat(F.col("body"), F.lit("\n\nOmitted: "), F.coalesce("omitted", F.lit(0)).cast("string")).alias("markdown"))


def substring_pairs(texts: DataFrame, quotes: DataFrame) -> DataFrame:
    """(text_id, quote_id) with the quote an exact substring of the text.

    Blocked: a quote of five or more blank-separated words is looked up by three of its
    inner words, which any text that holds it has as whole words in a row; only those
    pairs are compared. Shorter quotes are compared with every text, in one pass over the
    texts with the short quotes as the join's small side.
    """
    parts = lambda c: F.split(c, r"\s+")
    q = quotes.where(F.length("quote") > 0).withColumn("_w", parts("quote"))
    gram = lambda w, i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2])
    long = q.where(F.size("_w") >= 5).withColumn("gram", F.concat_ws(" ", F.col("_w")[1], F.col("_w")[2], F.col("_w")[3])).select("quote_id", "quote", "gram")
    grams = texts.select("text_id", parts("text").alias("_w")).where(F.size("_w") >= 5).select("text_id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: gram(F.col("_w"), i)))).alias("gram"))
    hits = grams.select("text_id", "gram").join(long, "gram").select("text_id", "quote_id", "quote")
    blocked = hits.join(texts.select("text_id", "text"), "text_id").where(F.contains("text", "quote")).select("text_id", "quote_id")
    short = q.where(F.size("_w") < 5).select("quote_id", "quote")
    rest = texts.join(short, F.contains("text", "quote")).select("text_id", "quote_id")
    return blocked.distinct().unionByName(rest.distinct())


def overlapping_pairs(texts: DataFrame, quotes: DataFrame, floor: int = 12) -> DataFrame:
    """(text_id, quote_id) of texts and quotes that are equal, or one of which holds the other.

    A held side has at least ``floor`` characters; equal ones count at any length but none.
    """
    inside = substring_pairs(texts, quotes.where(F.length("quote") >= floor))
    turned = lambda df, a, b: df.select(F.col(f"{a}_id").alias(f"{b}_id"), F.col(a).alias(b))
    longest = quotes.agg(F.max(F.length("quote")).alias("_longest"))
    held = texts.where(F.length("text") >= floor).join(F.broadcast(longest), F.length("text") <= F.col("_longest"))
    around = substring_pairs(turned(quotes, "quote", "text"), turned(held, "text", "quote"))
    around = around.select(F.col("quote_id").alias("text_id"), F.col("text_id").alias("quote_id"))
    short = texts.where(F.length("text").between(1, floor - 1)).join(quotes, F.col("text") == F.col("quote")).select("text_id", "quote_id")
    return inside.unionByName(around).unionByName(short).distinct()

"""Evaluation operators over documents, benchmark items, vectors and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import evaluation as V
from quarry.operators import evidence as E
from quarry.plans import bindings as B
from quarry.plans.evidence_queries import CHECK, _evidence
from quarry.plans.registry import query
from quarry.session import table


def _overlaps(spark, sf_dir):
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    pairs = E.overlapping_pairs(d.select(F.col("doc_id").alias("text_id"), "text"), b.select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote")))
    return pairs.select(F.col("text_id").alias("doc_id"), F.col("quote_id").alias("item_id"))


@query("quote_overlap_recall", "WITH hits AS (SELECT DISTINCT lang, item_id FROM documents d JOIN benchmark b ON length(b.text) >= 12 AND contains(d.text, b.text)), langs AS (SELECT DISTINCT lang FROM documents) SELECT l.lang, count(*) AS n, count(h.item_id) AS recalled, round(CAST(count(h.item_id) AS DOUBLE) / count(*), 6) AS recall FROM langs l CROSS JOIN benchmark b LEFT JOIN hits h ON h.lang = l.lang AND h.item_id = b.item_id GROUP BY l.lang")
def quote_overlap_recall(spark, sf_dir):
    """Benchmark items that a document of a language overlaps; keys are (language, item)."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    hits = _overlaps(spark, sf_dir).join(d.select("doc_id", "lang"), "doc_id").select("lang", "item_id")
    langs = d.groupBy().agg(F.collect_set("lang").alias("l")).select(F.explode("l").alias("lang"))
    return V.recall(b.select("item_id").crossJoin(langs), hits, ["lang", "item_id"], ["lang"])


@query("quote_overlap_matched", "WITH m AS (SELECT DISTINCT doc_id FROM documents d JOIN benchmark b ON (d.text = b.text AND length(b.text) > 0) OR (length(b.text) >= 12 AND contains(d.text, b.text)) OR (length(d.text) >= 12 AND contains(b.text, d.text))) SELECT d.lang, count(*) AS n, count(m.doc_id) AS matched, round(CAST(count(m.doc_id) AS DOUBLE) / count(*), 6) AS gold_match_rate FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.lang")
def quote_overlap_matched(spark, sf_dir):
    """Documents of a language that overlap a benchmark item, whichever one."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    found = V.recall(d, _overlaps(spark, sf_dir), ["doc_id"], ["lang"])
    return found.select("lang", "n", F.col("recalled").alias("matched"), F.col("recall").alias("gold_match_rate"))


@query("bait_rejection", CHECK + ", held AS (SELECT c.claim_id, c.source_id, bool_and(NOT contains(coalesce(k.text, ''), e.quote)) AS held FROM claims c JOIN evidence e ON e.claim_id = c.claim_id LEFT JOIN chunks k ON k.locator = 'd' || (c.doc_id + 1) GROUP BY c.claim_id, c.source_id), per AS (SELECT source_id, avg(CASE WHEN held THEN 1.0 ELSE 0.0 END) AS r FROM held GROUP BY source_id) SELECT count(*) AS sources, round(avg(r), 6) AS bait_rejection FROM per")
def bait_rejection(spark, sf_dir):
    """Each document is bait copied from the next one: a claim is rejected if none of its quotes
    stands there."""
    claims = B.claims(spark, sf_dir)
    source = claims.select("claim_id", F.concat(F.lit("d"), (F.col("ord") + 1).cast("string")).alias("locator"))
    quotes = _evidence(spark, sf_dir).select("claim_id", "source_id", "quote").join(source, "claim_id")
    return V.bait_rejection(E.with_chunk_text(quotes, B.chunks(spark, sf_dir)), "source_id")


ALLOWED = ["the", "and", "of", "der", "die", "que"]


@query("coverage", r"WITH c AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x IN ('the', 'and', 'of', 'der', 'die', 'que', 'con', 'les'))) AS cited, CASE doc_id % 2 WHEN 0 THEN ['the', 'and', 'of'] ELSE ['the', 'and', 'of', 'der', 'die', 'que'] END AS allowed FROM documents), m AS (SELECT doc_id, len(list_intersect(cited, allowed)) AS hit, len(allowed) AS n, len(cited) - len(list_intersect(cited, allowed)) AS other FROM c) SELECT doc_id, round(CAST(hit AS DOUBLE) / n, 6) AS share, CAST(other AS INTEGER) AS foreign_ids, (CASE WHEN n < 4 THEN hit = n ELSE CAST(hit AS DOUBLE) / n >= 0.5 END) AND other = 0 AS passed FROM m")
def coverage(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    cited = F.array_distinct(F.filter(X.tokens(F.col("text")), lambda x: x.isin(*ALLOWED, "con", "les")))
    allowed = F.when(F.col("doc_id") % 2 == 0, F.array(*[F.lit(a) for a in ALLOWED[:3]])).otherwise(F.array(*[F.lit(a) for a in ALLOWED]))
    share, foreign, passed = V.coverage(cited, allowed, 0.5)
    return d.select("doc_id", F.round(share, 6).alias("share"), foreign.alias("foreign_ids"), passed.alias("passed"))


@query("marker_rates", r"SELECT lang, sum(1 + doc_id % 2) AS claim_markers, sum(doc_id % 3) AS bare_markers FROM documents GROUP BY lang")
def marker_rates(spark, sf_dir):
    """Markers counted in prose built to hold one or two of one kind and up to two of the other."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id").cast("string")
    prose = F.concat(F.lit("so [claim:c_"), i, F.lit("] "), F.when(F.col("doc_id") % 2 == 1, F.lit("and [claim:c_x.1] ")).otherwise(""), F.repeat(F.lit("see [c_9] "), (F.col("doc_id") % 3).cast("int")))
    counted = d.select("lang", F.regexp_count(prose, F.lit(X.MARKER)).alias("a"), F.regexp_count(prose, F.lit(r"\[c_[A-Za-z0-9_.\-]+\]")).alias("b"))
    return counted.groupBy("lang").agg(F.sum("a").alias("claim_markers"), F.sum("b").alias("bare_markers"))


@query("atomicity_stats", "SELECT lang, count(*) AS n, round(avg(n_chars), 6) AS mean, median(n_chars) AS median, min(n_chars) AS least, max(n_chars) AS most FROM documents GROUP BY lang")
def atomicity_stats(spark, sf_dir):
    return V.summary(table(spark, sf_dir, "documents"), "lang", "n_chars")


WILSON = "round(greatest(0.0, (p + 3.8416 / (2 * runs) - 1.96 * sqrt(p * (1 - p) / runs + 3.8416 / (4.0 * runs * runs))) / (1 + 3.8416 / runs)), 9) AS low, round(least(1.0, (p + 3.8416 / (2 * runs) + 1.96 * sqrt(p * (1 - p) / runs + 3.8416 / (4.0 * runs * runs))) / (1 + 3.8416 / runs)), 9) AS high"


@query("wilson", f"SELECT source, runs, passes, {WILSON} FROM (SELECT source, count(*) AS runs, count(*) FILTER (WHERE n_chars > 1000) AS passes, CAST(count(*) FILTER (WHERE n_chars > 1000) AS DOUBLE) / count(*) AS p FROM documents GROUP BY source)")
def wilson(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("runs"), F.count(F.when(F.col("n_chars") > 1000, 1)).alias("passes"))
    low, high = X.wilson(F.col("passes"), F.col("runs"))
    return g.select("source", "runs", "passes", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


@query("flake_rates", f"WITH g AS (SELECT source, count(*) AS runs, count(*) FILTER (WHERE n_chars > 500) AS passes, CAST(count(*) FILTER (WHERE n_chars > 500) AS DOUBLE) / count(*) AS p FROM documents GROUP BY source), e AS (SELECT source, string_agg(lang, '|' ORDER BY doc_id) AS errors FROM (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents WHERE n_chars <= 500) WHERE n <= 3 GROUP BY source) SELECT source, runs, passes, round(p, 6) AS rate, {WILSON}, coalesce(errors, '') AS errors FROM g LEFT JOIN e USING (source)")
def flake_rates(spark, sf_dir):
    return V.flake_rates(table(spark, sf_dir, "documents"), "source", "doc_id", F.col("n_chars") > 500, "lang")


@query("extract_metrics", CHECK + ", m AS (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE reasons = '') AS ok, count(*) FILTER (WHERE n_evidence > 0) AS with_evidence FROM checked GROUP BY source_id) SELECT source_id, n, round(CAST(ok AS DOUBLE) / n, 6) AS gate_pass_rate, round(CAST(with_evidence AS DOUBLE) / n, 6) AS evidence_rate, round(CASE WHEN ok + with_evidence > 0 THEN 2 * (CAST(ok AS DOUBLE) / n) * (CAST(with_evidence AS DOUBLE) / n) / (CAST(ok AS DOUBLE) / n + CAST(with_evidence AS DOUBLE) / n) END, 6) AS f_fact FROM m")
def extract_metrics(spark, sf_dir):
    checked = E.claims_check(B.claims(spark, sf_dir), _evidence(spark, sf_dir), B.chunks(spark, sf_dir))
    m = checked.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("ok"), 1)).alias("ok"), F.count(F.when(F.col("n_evidence") > 0, 1)).alias("e"))
    gate, evidence = F.col("ok") / F.col("n"), F.col("e") / F.col("n")
    return m.select("source_id", "n", F.round(gate, 6).alias("gate_pass_rate"), F.round(evidence, 6).alias("evidence_rate"), F.round(V.harmonic(gate, evidence), 6).alias("f_fact"))


@query("embed_recall", "WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL) SELECT r.label, count(*) AS n, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM v p WHERE p.label = 0 AND list_cosine_similarity(p.e, r.e) >= 0.6)) AS recalled FROM v r WHERE r.label <> 0 GROUP BY r.label")
def embed_recall(spark, sf_dir):
    """Vectors of other labels that one of label 0 comes near."""
    e = table(spark, sf_dir, "embeddings").where("embedding is not null").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")
    reference = e.where("label <> 0")
    hits = V.similar_vectors(e.where("label = 0").select("id", "v"), reference.select("id", "v"), 0.6)
    return V.recall(reference.select("id", "label"), hits, ["id"], ["label"]).select("label", "n", "recalled")


@query("report_compare", "WITH p AS (SELECT source, round(avg(value), 6) AS m FROM (SELECT source, n_chars / 1000.0 AS value FROM documents) GROUP BY source), c AS (SELECT source, round(avg(value), 6) AS m FROM (SELECT source, n_chars / 1000.0 AS value FROM documents WHERE lang <> 'de' AND source <> 'src4') GROUP BY source) SELECT p.source, p.m AS previous, c.m AS current, coalesce((p.m IS NOT NULL AND c.m IS NULL) OR p.m - c.m > 0.03, false) AS regression FROM p LEFT JOIN c USING (source)")
def report_compare(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    mean = lambda df: df.groupBy("source").agg(F.round(F.avg(F.col("n_chars") / 1000.0), 6).alias("m"))
    return V.compare_reports(mean(d.where("lang <> 'de' and source <> 'src4'")), mean(d), "source", "m")


@query("paired_deltas", "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CAST(CASE WHEN b.doc_id IS NULL THEN 1 WHEN a.doc_id IS NULL THEN -1 ELSE 0 END AS INTEGER) AS delta FROM (SELECT doc_id FROM documents WHERE n_chars > 800) a FULL OUTER JOIN (SELECT doc_id FROM documents WHERE lang <> 'en') b ON a.doc_id = b.doc_id")
def paired_deltas(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return V.paired_deltas(d.where("n_chars > 800"), d.where("lang <> 'en'"), "doc_id")


@query("history_flatten", "SELECT source, unnest(['mean', 'docs']) AS metric, unnest([round(avg(n_chars), 6), CAST(count(*) AS DOUBLE)]) AS value FROM documents GROUP BY source")
def history_flatten(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy("source").agg(F.round(F.avg("n_chars"), 6).alias("mean"), F.count(F.lit(1)).alias("docs"))
    return V.flattened_history(g, "source", ["mean", "docs"])


@query("promotion_gates", "WITH g AS (SELECT source, count(*) AS n, avg(n_chars) AS chars, avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) AS en, count(DISTINCT lang) AS langs FROM documents GROUP BY source) SELECT source, CAST(CASE WHEN NOT n >= 45 THEN 6 WHEN NOT chars > 1500 THEN 2 WHEN NOT en > 0.4 THEN 3 WHEN NOT langs = 4 THEN 4 WHEN NOT n % 2 = 0 THEN 5 ELSE 0 END AS INTEGER) AS exit_code FROM g")
def promotion_gates(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("chars"), F.avg(F.when(F.col("lang") == "en", 1.0).otherwise(0.0)).alias("en"), F.countDistinct("lang").alias("langs"))
    return g.select("source", V.promotion_gate(F.col("n") >= 45, F.col("chars") > 1500, F.col("en") > 0.4, F.col("langs") == 4, F.col("n") % 2 == 0).alias("exit_code"))


@query("bootstrap_ci")
def bootstrap_ci(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return V.bootstrap_means(rows, "lang", "doc_id", "n_chars")

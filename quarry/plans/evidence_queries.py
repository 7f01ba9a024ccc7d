"""Gates, merges, dossiers, lints and ledgers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import evidence as E
from quarry.operators import lint as L
from quarry.plans import bindings as B
from quarry.plans.registry import query
from quarry.session import table

CLAIMS = "WITH " + B.CLAIMS_SQL.strip()
CHECK = CLAIMS + """, judged AS (SELECT e.*, CASE WHEN e.quote = '' THEN 'empty quote: ' || e.locator WHEN NOT contains(coalesce(c.text, ''), e.quote) THEN 'not verbatim: ' || e.locator END AS reason FROM evidence e LEFT JOIN chunks c ON c.locator = e.locator),
checked AS (SELECT c.claim_id, c.producer, c.source_id, c.claim, count(j.claim_id) AS n_evidence, CASE WHEN count(j.claim_id) = 0 THEN 'no evidence' ELSE coalesce(string_agg(j.reason, '; ' ORDER BY j.pos), '') END AS reasons FROM claims c LEFT JOIN judged j ON j.claim_id = c.claim_id GROUP BY c.claim_id, c.producer, c.source_id, c.claim)"""


def _evidence(spark, sf_dir):
    return E.normalised_evidence(E.flatten_evidence(B.claims(spark, sf_dir)))


@query("claims_flatten", CLAIMS + " SELECT claim_id, producer, source_id, CAST(pos AS INTEGER) AS pos, locator FROM evidence")
def claims_flatten(spark, sf_dir):
    return E.flatten_evidence(B.claims(spark, sf_dir)).select("claim_id", "producer", "source_id", "pos", "locator")


@query("evidence_normalize", CLAIMS + " SELECT claim_id, producer, source_id, CAST(pos AS INTEGER) AS pos, locator, page, url, quote FROM evidence")
def evidence_normalize(spark, sf_dir):
    return _evidence(spark, sf_dir)


@query("mentions_explode", "SELECT 's:' || s_suppkey AS entity_id, s_name AS name, 'n:' || s_nationkey AS locator FROM supplier UNION ALL SELECT 's:' || s_suppkey, s_name, 'r:' || n_regionkey FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def mentions_explode(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    mentions = F.array(F.concat(F.lit("n:"), F.col("s_nationkey").cast("string")), F.concat(F.lit("r:"), F.col("n_regionkey").cast("string")))
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    return joined.select(F.concat(F.lit("s:"), F.col("s_suppkey").cast("string")).alias("entity_id"), F.col("s_name").alias("name"), F.explode(mentions).alias("locator"))


@query("claims_by_chunk", CLAIMS + " SELECT locator, string_agg(claim_id, ',' ORDER BY claim_id) AS claim_ids, count(*) AS n FROM evidence GROUP BY locator")
def claims_by_chunk(spark, sf_dir):
    ids = F.array_join(F.array_sort(F.collect_list("claim_id")), ",")
    return _evidence(spark, sf_dir).groupBy("locator").agg(ids.alias("claim_ids"), F.count(F.lit(1)).alias("n"))


PAIRS_SQL = "pairs AS (SELECT doc_id, item_id, d.text AS text, b.text AS quote FROM documents d JOIN benchmark b ON length(b.text) > 0 AND contains(d.text, b.text))"


def _pairs(spark, sf_dir):
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    pairs = E.substring_pairs(d.select(F.col("doc_id").alias("text_id"), "text"), b.select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote")))
    return pairs.select(F.col("text_id").alias("doc_id"), F.col("quote_id").alias("item_id"))


@query("verbatim_gate", f"WITH {PAIRS_SQL} SELECT doc_id, item_id FROM pairs")
def verbatim_gate(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query("locate_spans", f"WITH {PAIRS_SQL} SELECT doc_id, item_id, CAST(instr(text, quote) - 1 AS INTEGER) AS start_char, CAST(instr(text, quote) - 1 + length(quote) AS INTEGER) AS end_char FROM pairs")
def locate_spans(spark, sf_dir):
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = _pairs(spark, sf_dir).join(d.select("doc_id", "text"), "doc_id").join(b.select("item_id", F.col("text").alias("quote")), "item_id")
    start = F.instr("text", F.col("quote")) - 1
    return found.select("doc_id", "item_id", start.alias("start_char"), (start + F.length("quote")).alias("end_char"))


@query("slice_span", "SELECT doc_id, CASE WHEN s >= 0 AND e <= length(text) AND s < e THEN substr(text, CAST(s AS INTEGER) + 1, CAST(e - s AS INTEGER)) END AS piece FROM (SELECT doc_id, text, doc_id % 90 - 5 AS s, doc_id % 140 AS e FROM documents)")
def slice_span(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.slice_span(F.col("text"), F.col("doc_id") % 90 - 5, F.col("doc_id") % 140).alias("piece"))


@query("span_gate", "SELECT doc_id, CASE WHEN s >= 0 AND e <= length(text) AND s < e THEN quote IS NULL OR substr(text, CAST(s AS INTEGER) + 1, CAST(e - s AS INTEGER)) = quote ELSE false END AS ok FROM (SELECT doc_id, text, doc_id % 9 AS s, doc_id % 9 + 20 AS e, CASE doc_id % 3 WHEN 0 THEN substr(text, 1, 20) WHEN 1 THEN '' END AS quote FROM documents)")
def span_gate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    start = F.col("doc_id") % 9
    quote = F.when(F.col("doc_id") % 3 == 0, F.substring("text", 1, 20)).when(F.col("doc_id") % 3 == 1, F.lit(""))
    return d.select("doc_id", X.span_ok(start, start + 20, F.col("text"), quote).alias("ok"))


@query("claims_check", CHECK + " SELECT claim_id, producer, source_id, n_evidence, reasons = '' AS ok, reasons FROM checked")
def claims_check(spark, sf_dir):
    return E.claims_check(B.claims(spark, sf_dir), _evidence(spark, sf_dir), B.chunks(spark, sf_dir))


@query("claims_check_counts", CHECK + " SELECT count(*) AS checked, count(*) FILTER (WHERE reasons = '') AS ok, count(*) FILTER (WHERE reasons <> '') AS failed FROM checked")
def claims_check_counts(spark, sf_dir):
    rows = E.claims_check(B.claims(spark, sf_dir), _evidence(spark, sf_dir), B.chunks(spark, sf_dir))
    return rows.agg(F.count(F.lit(1)).alias("checked"), F.count(F.when(F.col("ok"), 1)).alias("ok"), F.count(F.when(~F.col("ok"), 1)).alias("failed"))


@query("claim_gate", CHECK + " SELECT claim_id, producer, source_id FROM checked WHERE reasons = ''")
def claim_gate(spark, sf_dir):
    return E.claim_gate(B.claims(spark, sf_dir), _evidence(spark, sf_dir), B.chunks(spark, sf_dir))


DOSSIER = CHECK + """, asked AS (SELECT 'c_' || doc_id AS claim_id, doc_id AS pos FROM documents UNION ALL SELECT 'c_missing', -1),
bad AS (SELECT claim_id, string_agg(locator, ', ' ORDER BY locator) AS bad FROM judged WHERE reason IS NOT NULL GROUP BY claim_id),
verdict AS (SELECT a.pos, a.claim_id, c.claim, CASE WHEN c.claim_id IS NULL THEN 'not found' WHEN c.n_evidence = 0 THEN 'no evidence' WHEN b.bad IS NOT NULL THEN 'not verbatim: ' || b.bad ELSE '' END AS reason FROM asked a LEFT JOIN checked c ON c.claim_id = a.claim_id LEFT JOIN bad b ON b.claim_id = a.claim_id)"""


@query("dossier", DOSSIER + """ SELECT pos, claim_id, CASE WHEN reason = '' THEN 'included' ELSE 'rejected' END AS status, reason, claim FROM verdict""")
def dossier(spark, sf_dir):
    return _dossier(spark, sf_dir)


def _dossier(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.concat(F.lit("c_"), F.col("doc_id").cast("string")).alias("claim_id"), F.col("doc_id").alias("pos"))
    ids = ids.union(spark.createDataFrame([("c_missing", -1)], "claim_id string, pos long"))
    return E.dossier(ids, B.claims(spark, sf_dir), _evidence(spark, sf_dir), B.chunks(spark, sf_dir))


@query("dossier_markdown", DOSSIER + """ SELECT coalesce(string_agg(n || '. ' || claim || ' [claim:' || claim_id || ']', chr(10) ORDER BY pos), '') || chr(10) || chr(10) || 'Omitted: ' || (SELECT count(*) FROM verdict WHERE reason <> '') AS markdown FROM (SELECT *, row_number() OVER (ORDER BY pos) AS n FROM verdict WHERE reason = '')""")
def dossier_markdown(spark, sf_dir):
    return E.render_dossier(_dossier(spark, sf_dir))


@query("contradictions", "SELECT 'part:' || l_partkey AS subject, 'flag' AS predicate, count(DISTINCT l_returnflag) AS n_objects, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS objects, string_agg(l_orderkey || '-' || l_linenumber, ',' ORDER BY l_orderkey || '-' || l_linenumber) AS relation_ids, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS sources FROM lineitem WHERE l_linenumber <> 4 GROUP BY l_partkey HAVING count(DISTINCT l_returnflag) > 1")
def contradictions(spark, sf_dir):
    """A fourth line has no object: it makes no candidate, and none of its ids or sources shows."""
    r = B.relations(spark, sf_dir)
    found = E.contradictions(r.withColumn("object", F.when(~F.col("relation_id").endswith("-4"), F.col("object"))))
    return found.select("subject", "predicate", "n_objects", *[F.array_join(c, ",").alias(c) for c in ("objects", "relation_ids", "sources")])


@query("entity_merge", """WITH e AS (SELECT CAST(l_suppkey AS VARCHAR) AS entity_id, l_returnflag || l_linestatus || '-' || repeat('x', CAST(l_linenumber AS INTEGER)) || l_linenumber AS name, l_linestatus AS alias, l_returnflag AS type, l_linestatus AS producer, CAST(l_partkey AS VARCHAR) AS source_id, l_orderkey, l_linenumber, l_partkey FROM lineitem),
best AS (SELECT entity_id, name FROM (SELECT entity_id, name, row_number() OVER (PARTITION BY entity_id ORDER BY length(name) DESC, name) AS n FROM e) WHERE n = 1),
types AS (SELECT entity_id, type FROM (SELECT entity_id, type, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, type) AS n FROM e GROUP BY entity_id, type) WHERE n = 1),
first AS (SELECT entity_id, producer, source_id FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM e) WHERE n = 1),
others AS (SELECT x.entity_id, string_agg(DISTINCT x.a, '|' ORDER BY x.a) AS aliases FROM (SELECT entity_id, name AS a FROM e UNION SELECT entity_id, alias FROM e) x JOIN best USING (entity_id) WHERE x.a <> best.name GROUP BY x.entity_id)
SELECT entity_id, best.name, coalesce(aliases, '') AS aliases, type, producer, source_id FROM best JOIN types USING (entity_id) JOIN first USING (entity_id) LEFT JOIN others USING (entity_id)""")
def entity_merge(spark, sf_dir):
    return E.merge_entities(B.entities(spark, sf_dir)).withColumn("aliases", F.array_join("aliases", "|"))


@query("entity_lookup", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE lower(c_name) = lower('CUSTOMER#000000042') OR c_custkey = 7")
def entity_lookup(spark, sf_dir):
    return spark.sql("SELECT c_custkey, c_name, c_nationkey FROM {c} WHERE lower(c_name) = lower(:name) OR c_custkey = :id", args={"name": "CUSTOMER#000000042", "id": 7}, c=table(spark, sf_dir, "customer"))


@query("entity_relations", """WITH """ + B.PLACES_SQL.split("links AS")[0].strip().rstrip(",") + """ SELECT DISTINCT a, b FROM edges WHERE a = 'n:3' OR b = 'n:3'""")
def entity_relations(spark, sf_dir):
    """Relations with the entity at either end: two equi-filters, not a join on OR."""
    e = B.places(spark, sf_dir)
    return e.where("a = 'n:3'").union(e.where("b = 'n:3'")).distinct()


@query("distinct_sources", CLAIMS + " SELECT DISTINCT producer, source_id, coalesce(url, '') AS url FROM evidence")
def distinct_sources(spark, sf_dir):
    return _evidence(spark, sf_dir).select("producer", "source_id", F.coalesce("url", F.lit("")).alias("url")).distinct()


@query("suffix_resolve", """WITH names AS (SELECT 'doc:' || lang || ':' || doc_id AS id, CAST(doc_id AS VARCHAR) AS bare FROM documents),
asked AS (SELECT CAST(item_id AS VARCHAR) AS emitted FROM benchmark UNION ALL SELECT 'doc:en:' || item_id FROM benchmark UNION ALL SELECT 'en:' || item_id FROM benchmark),
exact AS (SELECT a.emitted, n.id FROM asked a JOIN names n ON n.id = a.emitted),
colon AS (SELECT a.emitted, min(n.id) AS id FROM asked a JOIN names n ON ends_with(n.id, ':' || a.emitted) GROUP BY a.emitted HAVING count(*) = 1),
bare AS (SELECT a.emitted, min(n.id) AS id FROM asked a JOIN names n ON length(a.emitted) >= 2 AND ends_with(n.id, a.emitted) GROUP BY a.emitted HAVING count(*) = 1)
SELECT a.emitted, coalesce(e.id, c.id, b.id) AS id FROM asked a LEFT JOIN exact e USING (emitted) LEFT JOIN colon c USING (emitted) LEFT JOIN bare b USING (emitted)""")
def suffix_resolve(spark, sf_dir):
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    names = d.select(F.concat_ws(":", F.lit("doc"), "lang", F.col("doc_id").cast("string")).alias("id"))
    i = F.col("item_id").cast("string")
    asked = b.select(F.explode(F.array(i, F.concat(F.lit("doc:en:"), i), F.concat(F.lit("en:"), i))).alias("emitted"))
    return L.resolve_suffixes(asked, names)


@query("schema_problems", "SELECT doc_id, concat_ws('; ', CASE WHEN length(coalesce(text, '')) < 40 THEN 'text too short' END, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'lang not allowed: ' || lang END, CASE WHEN n_chars <> length(text) THEN 'n_chars differs' END) AS problems FROM documents WHERE length(coalesce(text, '')) < 40 OR lang NOT IN ('en', 'de', 'fr') OR n_chars <> length(text)")
def schema_problems(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rules = [
        F.when(F.length(F.coalesce("text", F.lit(""))) < 40, F.lit("text too short")),
        F.when(~F.col("lang").isin("en", "de", "fr"), F.concat(F.lit("lang not allowed: "), "lang")),
        F.when(F.col("n_chars") != F.length("text"), F.lit("n_chars differs")),
    ]
    return d.select("doc_id", F.concat_ws("; ", *rules).alias("problems")).where("problems <> ''")


@query("page_links", f"WITH {B.PATHS_SQL} SELECT page_id, link, target FROM resolved")
def page_links(spark, sf_dir):
    return B.page_edges(spark, sf_dir).select("page_id", "link", "target")


@query("lint_broken_links", f"WITH {B.PATHS_SQL} SELECT DISTINCT page_id, link FROM resolved WHERE NOT regexp_matches(link, '^https?:') AND target NOT IN (SELECT path FROM paths)")
def lint_broken_links(spark, sf_dir):
    return L.broken_links(B.page_edges(spark, sf_dir), B.page_paths(spark, sf_dir))


@query("lint_orphans", f"WITH {B.PATHS_SQL} SELECT page_id, path FROM paths WHERE path <> '' AND path NOT IN (SELECT target FROM resolved)")
def lint_orphans(spark, sf_dir):
    return L.orphans(B.page_edges(spark, sf_dir), B.page_paths(spark, sf_dir))


@query("lint_stale", "SELECT o_orderkey, CAST(floor((epoch(TIMESTAMP '2000-01-01') - epoch(o_orderdate)) / 86400) AS BIGINT) AS age_days FROM orders WHERE o_orderstatus = 'O' AND floor((epoch(TIMESTAMP '2000-01-01') - epoch(o_orderdate)) / 86400) > 180")
def lint_stale(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return L.stale(o.where("o_orderstatus = 'O'"), "o_orderkey", F.col("o_orderdate"), "2000-01-01 00:00:00", 180)


@query("contradiction_candidates", f"""WITH {B.PATHS_SQL}, r AS (SELECT 'part:' || l_partkey AS subject, count(DISTINCT l_returnflag) AS n, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS objects FROM lineitem GROUP BY l_partkey)
SELECT 'relation' AS kind, subject, objects, CAST(NULL AS VARCHAR) AS path FROM r WHERE n > 1 UNION ALL SELECT 'conflicted_page', NULL, NULL, path FROM paths WHERE page_id % 5 = 2""")
def contradiction_candidates(spark, sf_dir):
    pages = B.page_paths(spark, sf_dir).select("path", F.when(F.col("page_id") % 5 == 2, "conflicted").otherwise("seed").alias("status"))
    return E.contradiction_candidates(B.relations(spark, sf_dir), pages).select("kind", "subject", F.array_join("objects", ",").alias("objects"), "path")


@query("dangling_relations", "SELECT l_orderkey || '-' || l_linenumber AS relation_id FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'O' WHERE l_linenumber = 1 OR o_orderkey IS NOT NULL")
def dangling_relations(spark, sf_dir):
    """Lines as relations: the first names no claim, the others the order, known if it is open."""
    line, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    named = line.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("relation_id"), F.when(F.col("l_linenumber") > 1, F.col("l_orderkey").cast("string")).alias("supporting_claim"))
    return E.without_dangling(named, o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("string").alias("claim_id"))).select("relation_id")


@query("claim_spans", "WITH e AS (SELECT doc_id, unnest([0, 1]) AS k, text FROM documents WHERE doc_id % 4 <> 3), j AS (SELECT doc_id, CASE WHEN k = 1 AND doc_id % 4 = 2 THEN false ELSE length(text) >= (k + 1) * 20 END AS ok FROM e) SELECT 'c_' || d.doc_id AS claim_id, coalesce(bool_and(ok), false) AS valid FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id GROUP BY d.doc_id")
def claim_spans(spark, sf_dir):
    """Two spans for each document but every fourth; some second ones echo another quote."""
    d = table(spark, sf_dir, "documents")
    start = F.col("k") * 20
    quote = F.when((F.col("k") == 1) & (F.col("doc_id") % 4 == 2), F.lit("another quote")).otherwise(F.expr("substring(text, k * 20 + 1, 20)"))
    cited = d.where("doc_id % 4 <> 3").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    claim, locator = F.concat(F.lit("c_"), F.col("doc_id").cast("string")).alias("claim_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("locator")
    evidence = cited.select(claim, locator, start.alias("start_char"), (start + 20).alias("end_char"), quote.alias("quote"))
    return E.spans_valid(d.select(claim), evidence, B.chunks(spark, sf_dir))


KB_SQL = f"""WITH {B.PATHS_SQL},
kb AS (SELECT page_id, path, page_id % 11 <> 0 AS front, CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Index' ELSE 'Topic' END AS type, CASE WHEN page_id % 13 <> 0 THEN 'T' END AS title, CASE page_id % 3 WHEN 0 THEN '1999-01-02' WHEN 1 THEN '1999-12-31' ELSE 'soon' END AS timestamp, CASE WHEN page_id % 17 = 0 THEN 'odd' WHEN page_id % 2 = 0 THEN 'researched' END AS status FROM paths),
good AS (SELECT path, link, target FROM resolved WHERE NOT regexp_matches(link, '^https?:') AND path IN (SELECT path FROM kb WHERE front))
SELECT 'schema' AS category, path, 'missing frontmatter block' AS detail FROM kb WHERE NOT front
UNION ALL SELECT 'schema', path, 'missing required field ''type''' FROM kb WHERE front AND type IS NULL
UNION ALL SELECT 'schema', path, 'missing required field ''title''' FROM kb WHERE front AND title IS NULL
UNION ALL SELECT 'schema', path, 'invalid status ''odd''' FROM kb WHERE front AND status = 'odd'
UNION ALL SELECT 'schema', path, 'unparseable timestamp ''soon''' FROM kb WHERE front AND status = 'researched' AND timestamp = 'soon'
UNION ALL SELECT 'stale', path, 'last updated 363 days ago' FROM kb WHERE front AND status = 'researched' AND timestamp = '1999-01-02'
UNION ALL SELECT 'broken-link', path, 'links to missing file ''' || link || '''' FROM good WHERE target NOT IN (SELECT path FROM kb)
UNION ALL SELECT 'orphan', path, 'no incoming links' FROM kb WHERE front AND coalesce(type, '') <> 'Index' AND NOT regexp_matches(path, '(^|/)index[.]md$') AND path NOT IN (SELECT target FROM good)"""


@query("kb_lint", KB_SQL)
def kb_lint(spark, sf_dir):
    """Pages as a knowledge base, with front matter that is missing or odd by their number."""
    n = F.col("page_id")
    kind = F.when(n % 7 == 0, F.lit(None)).when(n % 7 == 1, "Index").otherwise("Topic")
    stamp = F.when(n % 3 == 0, "1999-01-02").when(n % 3 == 1, "1999-12-31").otherwise("soon")
    status = F.when(n % 17 == 0, "odd").when(n % 2 == 0, "researched")
    pages = B.page_paths(spark, sf_dir).select("path", (n % 11 != 0).alias("has_front"), kind.alias("type"), F.when(n % 13 != 0, "T").alias("title"), stamp.alias("timestamp"), status.alias("status"))
    return L.knowledge_base(pages, B.page_edges(spark, sf_dir), "1999-12-31 12:00:00")


@query("ocr_garbage", r"SELECT source, count(*) AS pages, count(*) FILTER (WHERE length(text) > 0 AND 1 - length(regexp_replace(text, '[^\x09-\x0d\x20-\x7e]', '', 'g')) / CAST(length(text) AS DOUBLE) > 0.05) AS garbage FROM documents GROUP BY source")
def ocr_garbage(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.count(F.when(X.unprintable_share(F.col("text")) > 0.05, 1)).alias("garbage"))


@query("route_case", r"""WITH s AS (SELECT source, avg(length(text)) AS chars, avg(CASE WHEN length(rtrim(text)) < 10 THEN 1.0 ELSE 0.0 END) AS image_only, avg(CASE WHEN contains(text, '|') THEN 1.0 ELSE 0.0 END) AS tables, avg(len(regexp_extract_all(text, '[%$*#]'))) AS math, max(CASE WHEN contains(text, '____') THEN 1 ELSE 0 END) AS form FROM documents GROUP BY source)
SELECT source, round(chars, 6) AS chars, round(tables, 6) AS table_share, CASE WHEN math >= 5 THEN 'high' WHEN math >= 1 THEN 'medium' ELSE 'low' END AS math_density, CASE WHEN form = 1 THEN 'form' WHEN image_only >= 0.6 THEN 'scanned' WHEN math >= 5 THEN 'math' WHEN tables >= 0.6 THEN 'table-heavy' WHEN chars <= 150 THEN 'slides' ELSE 'digital-text' END AS route FROM s""")
def route_case(spark, sf_dir):
    return L.routes(table(spark, sf_dir, "documents"), "source", "text")


@query("slug_source_id", r"SELECT page_id, substr(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '[?#].*$', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) || '-' || substr(sha256(url), 1, 8) AS source_id FROM pages")
def slug_source_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.web_source_id(F.col("url")).alias("source_id"))


@query("ledger_view", "SELECT e.event_type, e.user_id, count(*) AS n, round(sum(e.value), 4) AS total, count(DISTINCT c.c_custkey) AS known FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id GROUP BY e.event_type, e.user_id")
def ledger_view(spark, sf_dir):
    """Runs left-joined to the registry they may or may not be in."""
    e, c = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    joined = e.join(c, e["user_id"] == c["c_custkey"], "left")
    return joined.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.countDistinct("c_custkey").alias("known"))


@query("ledger_validate", "SELECT event_id, concat_ws('; ', CASE WHEN NOT regexp_matches(event_type, '^[a-z_]+$') THEN 'event_type' END, CASE WHEN value IS NULL OR value < 10 THEN 'value' END, CASE WHEN NOT coalesce(json_valid(props), false) THEN 'props' END) AS violations FROM events WHERE NOT regexp_matches(event_type, '^[a-z_]+$') OR value IS NULL OR value < 10 OR NOT coalesce(json_valid(props), false)")
def ledger_validate(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rules = [
        F.when(~F.col("event_type").rlike("^[a-z_]+$"), "event_type"),
        F.when(F.col("value").isNull() | (F.col("value") < 10), "value"),
        F.when(F.try_parse_json("props").isNull(), "props"),
    ]
    return e.select("event_id", F.concat_ws("; ", *rules).alias("violations")).where("violations <> ''")


@query("snapshot_diff", "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'only left' WHEN a.doc_id IS NULL THEN 'only right' ELSE 'differs' END AS kind FROM (SELECT doc_id, sha256(text) AS h FROM documents WHERE source <> 'src1') a FULL OUTER JOIN (SELECT doc_id, sha256(trim(text)) AS h FROM documents WHERE source <> 'src2') b ON a.doc_id = b.doc_id WHERE a.h IS DISTINCT FROM b.h")
def snapshot_diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    left = d.where("source <> 'src1'").select("doc_id", F.sha2("text", 256).alias("h"))
    right = d.where("source <> 'src2'").select("doc_id", F.sha2(F.trim("text"), 256).alias("h"))
    return L.snapshot_diff(left, right, "doc_id", "h")

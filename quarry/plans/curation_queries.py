"""Curation operators over documents, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import curation as C
from quarry.operators import evidence as E
from quarry.plans import bindings as B
from quarry.plans.registry import query
from quarry.session import materialise, table

NORM = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"
SET = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> ''))"


@query("support_union", f"SELECT min(doc_id) AS ord, count(DISTINCT source) AS support, arg_min(source, doc_id) AS source_id FROM documents GROUP BY sha256({NORM}) HAVING count(DISTINCT source) >= 2")
def support_union(spark, sf_dir):
    claims = B.claims(spark, sf_dir).select("ord", "pass", "source_id", X.normalised_hash(F.col("claim")).alias("k"))
    return E.support_union(claims, F.col("k"), 2).select("ord", "support", "source_id")


@query("claim_key_dedup", r"SELECT min(doc_id) AS ord, arg_min(source, doc_id) AS source_id FROM documents GROUP BY sha256(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) || '||' || lang)")
def claim_key_dedup(spark, sf_dir):
    claims = B.claims(spark, sf_dir)
    key = F.sha2(X.claim_key(F.col("claim"), F.array("claim_type")), 256)
    return C.first_of_each(claims.select("ord", "source_id", key.alias("k")), F.col("k"), "ord").select("ord", "source_id")


@query("multi_pass_union", "SELECT min(doc_id) AS ord, count(DISTINCT n_chars % 3) AS support FROM documents GROUP BY lang, n_chars")
def multi_pass_union(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), (F.col("n_chars") % 3).alias("pass"), F.concat_ws("|", "lang", F.col("n_chars").cast("string")).alias("k"))
    return E.support_union(d, F.col("k"), 1).select("ord", "support")


@query("contamination", f"WITH g AS (SELECT item_id * 10 AS locator, sha256({NORM}) AS h FROM benchmark) SELECT doc_id, doc_id IN (SELECT locator FROM g) AS by_locator, sha256({NORM}) IN (SELECT h FROM g) AS by_text FROM documents WHERE doc_id IN (SELECT locator FROM g) OR sha256({NORM}) IN (SELECT h FROM g)")
def contamination(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 10).alias("locator"), "text")
    return C.contamination(table(spark, sf_dir, "documents"), "doc_id", "text", b)


@query("jaccard_pairs", f"WITH s AS (SELECT doc_id, {SET.format('text')} AS w FROM documents) SELECT a.doc_id, round(CASE WHEN len(a.w) = 0 AND len(b.w) = 0 THEN 1.0 ELSE CAST(len(list_intersect(a.w, b.w)) AS DOUBLE) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) END, 6) AS jaccard FROM s a JOIN s b ON b.doc_id = a.doc_id + 1")
def jaccard_pairs(spark, sf_dir):
    """Each document's word set against the next one's; ``similar_documents`` compares all."""
    s = table(spark, sf_dir, "documents").select("doc_id", X.token_set(F.col("text")).alias("w"))
    after = s.select((F.col("doc_id") - 1).alias("doc_id"), F.col("w").alias("w2"))
    return s.join(after, "doc_id").select("doc_id", F.round(X.jaccard(F.col("w"), F.col("w2")), 6).alias("jaccard"))


@query("similar_documents", f"""WITH d AS (SELECT doc_id, list_sort({SET.format('text')}) AS w FROM documents WHERE text IS NOT NULL), s AS (SELECT w, min(doc_id) AS id FROM d GROUP BY w), x AS (SELECT id, len(w) AS n, unnest(w) AS t FROM s),
o AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS shared FROM x a JOIN x b ON a.t = b.t AND a.id < b.id GROUP BY ALL)
SELECT a AS doc_id, b AS like_id, round(CAST(shared AS DOUBLE) / (na + nb - shared), 6) AS jaccard FROM o WHERE 100 * shared >= 80 * (na + nb - shared) UNION ALL SELECT DISTINCT s.id, d.doc_id, 1.0 FROM d JOIN s USING (w) WHERE d.doc_id <> s.id""")
def similar_documents(spark, sf_dir):
    """All documents whose word sets are alike by 0.8 or more, wherever their ids stand."""
    sets = table(spark, sf_dir, "documents").select("doc_id", X.token_set(F.col("text")).alias("w"))
    return C.similar_sets(sets).select("doc_id", "like_id", F.round("jaccard", 6).alias("jaccard"))


@query("near_copy", f"""WITH d AS (SELECT DISTINCT doc_id, s AS sentence FROM (SELECT doc_id, unnest(string_split(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))) AS s FROM documents)),
b AS (SELECT DISTINCT item_id, s AS sentence FROM (SELECT item_id, unnest(string_split(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))) AS s FROM benchmark)),
ds AS (SELECT doc_id, sentence, {SET.format('sentence')} AS w FROM d), bs AS (SELECT item_id, sentence, {SET.format('sentence')} AS w FROM b)
SELECT DISTINCT doc_id, item_id FROM ds JOIN bs ON len(ds.w) > 0 AND len(bs.w) > 0 AND ds.sentence <> bs.sentence AND len(ds.w) * 0.8 <= len(bs.w) AND len(bs.w) * 0.8 <= len(ds.w) AND CAST(len(list_intersect(ds.w, bs.w)) AS DOUBLE) / (len(ds.w) + len(bs.w) - len(list_intersect(ds.w, bs.w))) >= 0.8""")
def near_copy(spark, sf_dir):
    """Documents with a sentence that is nearly, but not exactly, one of a benchmark item."""

    def cut(df, id_col):
        s = df.select(F.col(id_col).alias("owner"), F.explode(X.sentences(F.col("text"))).alias("sentence"))
        return s.select(F.struct("owner", F.md5("sentence").alias("digest")).alias("id"), X.token_set(F.col("sentence")).alias("w"))

    found = C.near_copies(cut(table(spark, sf_dir, "documents"), "doc_id"), cut(table(spark, sf_dir, "benchmark"), "item_id"))
    return found.where("left_id.digest <> right_id.digest").select(F.col("left_id.owner").alias("doc_id"), F.col("right_id.owner").alias("item_id")).distinct()


@query("greedy_curate")
def greedy_curate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return C.greedy_curate(d.select("source", "doc_id", "text", F.length("text").alias("weight")), "source", "doc_id", X.token_set(F.col("text")), "weight")


@query("stratified_split", "WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY substr(sha256('42|' || doc_id), 1, 15), doc_id) AS n, count(*) OVER (PARTITION BY lang) AS size FROM documents) SELECT doc_id, lang, CASE WHEN n <= greatest(1, round_even(size * 0.1, 0)) THEN 'val' ELSE 'train' END AS part FROM r")
def stratified_split(spark, sf_dir):
    return C.stratified_split(table(spark, sf_dir, "documents"), "lang", "doc_id")


@query("round_robin_sample", """WITH s AS (SELECT lang AS slice, doc_id FROM documents UNION ALL SELECT source, doc_id FROM documents),
r AS (SELECT slice, doc_id, row_number() OVER (PARTITION BY slice ORDER BY sha256('7|' || doc_id), doc_id) AS r FROM s),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY r, slice) AS n FROM r)
SELECT CAST(row_number() OVER (ORDER BY r, slice) AS INTEGER) AS place, slice, doc_id FROM f WHERE n = 1 ORDER BY r, slice LIMIT 50""")
def round_robin_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    slices = d.select(F.col("lang").alias("slice"), "doc_id").union(d.select("source", "doc_id"))
    return C.round_robin_sample(slices, "slice", "doc_id", 50)


@query("prefix_budget", "SELECT o_custkey, o_orderkey, CAST(least(c, 500000 - before) AS BIGINT) AS taken FROM (SELECT o_custkey, o_orderkey, c, coalesce(sum(c) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS c FROM orders)) WHERE least(c, 500000 - before) > 0")
def prefix_budget(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.floor("o_totalprice").alias("c"))
    return C.prefix_budget(o, "o_custkey", ["o_orderkey"], "c", 500_000).select("o_custkey", "o_orderkey", "taken")


@query("escalation_first_round", "SELECT user_id, coalesce(min(event_id) FILTER (WHERE value >= 80), max(event_id)) AS event_id, round(coalesce(arg_min(value, event_id) FILTER (WHERE value >= 80), arg_max(value, event_id)), 6) AS value, coalesce(max(CASE WHEN value >= 80 THEN 1 ELSE 0 END) = 1, false) AS reached FROM events GROUP BY user_id")
def escalation_first_round(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.round("value", 6).alias("value"))
    return C.first_round_reaching(e, "user_id", "event_id", "value", 80.0)


@query("renamespace_dups", "SELECT o_orderkey, ['a', 'b', 'c'][(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) % 3 + 1] || '.' || o_custkey AS name FROM orders")
def renamespace_dups(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return C.renamespace(o, "o_custkey", "o_orderkey", ["a", "b", "c"]).select("o_orderkey", "name")


@query("unique_suffix", r"WITH s AS (SELECT p_partkey, substr(regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) AS s FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p_partkey) AS n FROM s) SELECT p_partkey, CASE n WHEN 1 THEN s ELSE s || '-' || n END AS slug FROM n")
def unique_suffix(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", X.slug(F.concat_ws(" ", "p_name", "p_brand")).alias("s"))
    return C.unique_suffix(p, "s", "p_partkey").select("p_partkey", F.col("unique").alias("slug"))


@query("route_map", "SELECT doc_id, CASE WHEN lang = 'de' THEN 'model-b' WHEN source IN ('src0', 'src1') THEN 'model-a' WHEN lang = 'fr' THEN 'model-c' ELSE 'fallback' END AS route, lang = 'de' OR source = 'src1' AS difficult FROM documents")
def route_map(spark, sf_dir):
    """The first tag in a row's own order that the table routes, else the fallback."""
    d = table(spark, sf_dir, "documents")
    routes = F.create_map(*[F.lit(x) for pair in (("de", "model-b"), ("src0", "model-a"), ("src1", "model-a"), ("fr", "model-c")) for x in pair])
    tags = F.when(F.col("lang") == "fr", F.array("source", "lang")).otherwise(F.array("lang", "source"))
    routed = F.filter(tags, lambda t: F.map_contains_key(routes, t))
    return d.select("doc_id", F.coalesce(F.try_element_at(F.transform(routed, lambda t: routes[t]), F.lit(1)), F.lit("fallback")).alias("route"), F.arrays_overlap(tags, F.array(F.lit("de"), F.lit("src1"))).alias("difficult"))


@query("corpus_word_range", r"SELECT doc_id, words FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS words FROM documents) WHERE words NOT BETWEEN 80 AND 450")
def corpus_word_range(spark, sf_dir):
    words = F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", words.alias("words")).where(~F.col("words").between(80, 450))


@query("corpus_dup_keys", "SELECT source, n_chars, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY source, n_chars HAVING count(*) > 1")
def corpus_dup_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", "n_chars").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("corpus_quota", "SELECT tag, count(*) AS n, count(*) >= 60 AS met FROM (SELECT unnest([lang, source]) AS tag FROM documents) GROUP BY tag")
def corpus_quota(spark, sf_dir):
    tags = table(spark, sf_dir, "documents").select(F.explode(F.array("lang", "source")).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).withColumn("met", F.col("n") >= 60)


#: The tables as an evaluation corpus: documents are chunks of their source, tagged by language
#: and source, claims are labels, and neighbours by id make bait and pairs.
CORPUS_SQL = r"""WITH chunks AS (SELECT CAST(doc_id AS VARCHAR) AS locator, source AS doc, text, doc_id FROM documents),
citations AS (SELECT CAST(l.doc_id AS VARCHAR) AS locator, source AS doc, 'q' || quality AS claim_id FROM labels l JOIN documents d ON d.doc_id = l.doc_id UNION ALL SELECT CAST(l.doc_id AS VARCHAR), source, 't' || toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
tags AS (SELECT CAST(doc_id AS VARCHAR) AS locator, lang AS slice FROM documents WHERE doc_id % 19 <> 0 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'bait' FROM documents WHERE doc_id % 10 = 3 UNION ALL SELECT 'x' || item_id, 'en' FROM benchmark),
bait AS (SELECT CAST(doc_id AS VARCHAR) AS locator, CASE WHEN doc_id % 3 = 0 THEN 'gone' ELSE CAST(doc_id + 1 AS VARCHAR) END AS source FROM documents WHERE doc_id % 10 = 3 AND doc_id % 7 <> 0),
pairs AS (SELECT CAST(doc_id AS VARCHAR) AS a, CAST(doc_id + 2 AS VARCHAR) AS b, 'q1' AS claim_a, 'q' || (doc_id % 4) AS claim_b, CASE doc_id % 3 WHEN 0 THEN 'contradiction' WHEN 1 THEN 'unclear' ELSE 'maybe' END AS verdict FROM documents WHERE doc_id % 5 = 0),
sound AS (SELECT * FROM pairs WHERE verdict IN ('contradiction', 'not_contradiction', 'unclear')),
sides AS (SELECT a || ' / ' || b || ' / a' AS pair, a AS locator, claim_a AS claim_id FROM sound UNION ALL SELECT a || ' / ' || b || ' / b', b, claim_b FROM sound),
here AS (SELECT s.*, k.doc FROM sides s JOIN chunks k ON k.locator = s.locator)
SELECT 'total chunks' AS rule, CAST(count(*) AS VARCHAR) AS subject FROM chunks HAVING count(*) NOT BETWEEN 1 AND 100
UNION ALL SELECT 'word range', locator FROM chunks WHERE len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '')) NOT BETWEEN 20 AND 450
UNION ALL SELECT 'citations of a chunk', k.locator FROM chunks k LEFT JOIN (SELECT locator, count(DISTINCT claim_id) AS n FROM citations GROUP BY locator) c ON c.locator = k.locator WHERE coalesce(n, 0) NOT BETWEEN 1 AND 9
UNION ALL SELECT DISTINCT 'indexed but missing', locator FROM tags WHERE locator NOT IN (SELECT locator FROM chunks)
UNION ALL SELECT 'not in the index', locator FROM chunks WHERE locator NOT IN (SELECT locator FROM tags)
UNION ALL SELECT 'unknown slice', locator || ' / ' || slice FROM tags WHERE slice NOT IN ('en', 'de', 'fr', 'bait')
UNION ALL SELECT 'slice quota', s FROM (SELECT unnest(['en', 'bait']) AS s, unnest([60, 100000]) AS least) q WHERE (SELECT count(*) FROM tags WHERE slice = q.s) < least
UNION ALL SELECT DISTINCT 'bait without source', locator FROM tags WHERE slice = 'bait' AND locator NOT IN (SELECT locator FROM bait)
UNION ALL SELECT 'bait of unknown source', locator FROM bait WHERE source NOT IN (SELECT locator FROM chunks)
UNION ALL SELECT 'bait of another document', b.locator FROM bait b JOIN chunks s ON s.locator = b.source LEFT JOIN chunks k ON k.locator = b.locator WHERE s.doc IS DISTINCT FROM k.doc
UNION ALL SELECT 'invalid verdict', a || ' / ' || b FROM pairs WHERE verdict NOT IN ('contradiction', 'not_contradiction', 'unclear')
UNION ALL SELECT 'pair of unknown chunk', pair FROM sides WHERE locator NOT IN (SELECT locator FROM chunks)
UNION ALL SELECT 'claim not in the document', pair FROM here WHERE NOT EXISTS (SELECT 1 FROM citations c WHERE c.doc = here.doc AND c.claim_id = here.claim_id)
UNION ALL SELECT 'claim does not cite the chunk', pair FROM here WHERE EXISTS (SELECT 1 FROM citations c WHERE c.doc = here.doc AND c.claim_id = here.claim_id) AND NOT EXISTS (SELECT 1 FROM citations c WHERE c.locator = here.locator AND c.claim_id = here.claim_id)
UNION ALL SELECT 'pair within a document', s.a || ' / ' || s.b FROM sound s JOIN chunks x ON x.locator = s.a JOIN chunks y ON y.locator = s.b WHERE verdict = 'contradiction' AND x.doc = y.doc
UNION ALL SELECT 'too few contradictions', CAST(count(*) AS VARCHAR) FROM sound WHERE verdict = 'contradiction' HAVING count(*) < 100000"""


@query("corpus_validate", CORPUS_SQL)
def corpus_validate(spark, sf_dir):
    d, labels, b = (table(spark, sf_dir, t) for t in ("documents", "labels", "benchmark"))
    n, at = F.col("doc_id"), F.col("doc_id").cast("string").alias("locator")
    known = labels.join(d.select("doc_id", "source"), "doc_id")
    mark = lambda prefix, c: known.select(at, F.col("source").alias("doc"), F.concat(F.lit(prefix), F.col(c).cast("string")).alias("claim_id"))
    tags = d.where(n % 19 != 0).select(at, F.col("lang").alias("slice")).unionByName(d.where(n % 10 == 3).select(at, F.lit("bait").alias("slice"))).unionByName(b.select(F.concat(F.lit("x"), F.col("item_id").cast("string")).alias("locator"), F.lit("en").alias("slice")))
    bait = d.where((n % 10 == 3) & (n % 7 != 0)).select(at, F.when(n % 3 == 0, "gone").otherwise((n + 1).cast("string")).alias("source"))
    verdict = F.when(n % 3 == 0, "contradiction").when(n % 3 == 1, "unclear").otherwise("maybe")
    pairs = d.where(n % 5 == 0).select(n.cast("string").alias("a"), (n + 2).cast("string").alias("b"), F.lit("q1").alias("claim_a"), F.concat(F.lit("q"), (n % 4).cast("string")).alias("claim_b"), verdict.alias("verdict"))
    return C.corpus_problems(d.select(at, F.col("source").alias("doc"), "text"), mark("q", "quality").unionByName(mark("t", "toxic")), tags, bait, pairs, ("en", "de", "fr", "bait"), {"en": 60, "bait": 100_000}, ("contradiction", "not_contradiction", "unclear"), (1, 100), (20, 450), (1, 9), 100_000)


@query("corpus_hash", "WITH l0 AS (SELECT doc_id AS k, sha256(coalesce(text, '')) AS h FROM documents), l1 AS (SELECT k // 1000 AS k, sha256(string_agg(h, chr(10) ORDER BY k)) AS h FROM l0 GROUP BY k // 1000), l2 AS (SELECT k // 1000 AS k, sha256(string_agg(h, chr(10) ORDER BY k)) AS h FROM l1 GROUP BY k // 1000), l3 AS (SELECT k // 1000 AS k, sha256(string_agg(h, chr(10) ORDER BY k)) AS h FROM l2 GROUP BY k // 1000) SELECT sha256(string_agg(h, chr(10) ORDER BY k)) AS corpus_sha256 FROM l3 GROUP BY k // 1000")
def corpus_hash(spark, sf_dir):
    return C.corpus_hash(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("repetition_loop")
def repetition_loop(spark, sf_dir):
    return C.repetition_loops(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("jsonl_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def jsonl_roundtrip(spark, sf_dir):
    from quarry.sources import jsonl

    return jsonl.roundtrip(table(spark, sf_dir, "documents"))


@query("ledger_corrupt_lines", "SELECT event_id AS line_key, event_id % 5 = 0 AS corrupt FROM events")
def ledger_corrupt_lines(spark, sf_dir):
    """Each fifth line of a ledger is cut short; the reader says which don't parse."""
    from quarry.sources import jsonl

    e = table(spark, sf_dir, "events")
    lines = e.select("event_id", F.when(F.col("event_id") % 5 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props")).alias("line"))
    return jsonl.judged_lines(lines, "line").select(F.col("event_id").alias("line_key"), "corrupt")


@query("sft_pipeline", f"""WITH g AS (SELECT doc_id, lang, sha256({NORM}) AS h FROM documents WHERE length(text) >= 200 AND doc_id NOT IN (SELECT item_id FROM benchmark) AND sha256({NORM}) NOT IN (SELECT sha256({NORM}) FROM benchmark)),
o AS (SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM g GROUP BY h),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY substr(sha256('42|' || doc_id), 1, 15), doc_id) AS n, count(*) OVER (PARTITION BY lang) AS size FROM o)
SELECT doc_id, lang, CASE WHEN n <= greatest(1, round_even(size * 0.1, 0)) THEN 'val' ELSE 'train' END AS part FROM r""")
def sft_pipeline(spark, sf_dir):
    """Guard, route, gate, de-duplicate, split: the training records and their parts."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    banned = C.contamination(d, "doc_id", "text", b.select(F.col("item_id").alias("locator"), "text")).select("doc_id")
    gated = d.join(banned, "doc_id", "left_anti").where(F.length("text") >= 200)
    once = C.first_of_each(gated.select("doc_id", "lang", "source", X.normalised_hash(F.col("text")).alias("k")), F.col("k"), "doc_id")
    once = materialise(once, "sft")
    return C.stratified_split(once, "lang", "doc_id")

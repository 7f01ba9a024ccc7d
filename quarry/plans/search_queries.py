"""Ranking, vectors and walks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import graph, search
from quarry.plans import bindings as B
from quarry.plans.registry import query
from quarry.session import table

#: The question asked of the documents.
QUESTION = "license idiot the version"
TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
BM25_SQL = rf"""
words AS (SELECT doc_id AS id, {TOKENS_SQL} AS w FROM documents),
figures AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM words),
terms AS (SELECT unnest(['license', 'idiot', 'the', 'version']) AS term),
tf AS (SELECT id, len(w) AS dl, term, len(list_filter(w, lambda x: x = term)) AS tf FROM words, terms),
df AS (SELECT term, count(*) FILTER (WHERE tf > 0) AS df FROM tf GROUP BY term),
scored AS (SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM tf JOIN df USING (term), figures GROUP BY id HAVING sum(tf) > 0),
lexical AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scored)"""
VECTOR_SQL = """
q AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1),
near AS (SELECT vec_id AS id, round(list_sum(list_transform(list_zip(embedding, q), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))), 6) AS score FROM embeddings, q),
vector AS (SELECT id, score, row_number() OVER (ORDER BY score, id) AS rank FROM near)"""
RRF_SQL = """
fused AS (SELECT id, round(sum(1.0 / (60 + rank)), 9) AS score, min(list * 1000 + rank) AS first FROM (SELECT id, rank, 0 AS list FROM lexical WHERE rank <= {k} UNION ALL SELECT id, rank, 1 FROM vector WHERE rank <= {k}) GROUP BY id),
final AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, first) AS rank FROM fused)"""


def _query_vector(spark, sf_dir):
    """The first vector of the table is the question's."""
    e = table(spark, sf_dir, "embeddings")
    return e.orderBy("vec_id").limit(1).select(F.col("embedding").alias("q"))


def _lexical(spark, sf_dir, k):
    return search.bm25_topk(table(spark, sf_dir, "documents"), "doc_id", "text", QUESTION, k)


def _hybrid(spark, sf_dir, k):
    return search.hybrid(table(spark, sf_dir, "documents"), "doc_id", "text", QUESTION, table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vector(spark, sf_dir), k)


@query("fts_postings", rf"SELECT id, term, count(*) AS tf, CAST(dl AS BIGINT) AS dl FROM (SELECT doc_id AS id, len(w) AS dl, unnest(w) AS term FROM (SELECT doc_id, {TOKENS_SQL} AS w FROM documents)) GROUP BY id, term, dl")
def fts_postings(spark, sf_dir):
    return search.postings(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("bm25_topk", f"WITH {BM25_SQL} SELECT id, score, rank FROM lexical WHERE rank <= 20")
def bm25_topk(spark, sf_dir):
    return _lexical(spark, sf_dir, 20)


@query("vector_topk", f"WITH {VECTOR_SQL} SELECT id, score, rank FROM vector WHERE rank <= 10")
def vector_topk(spark, sf_dir):
    return search.vector_topk(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vector(spark, sf_dir), 10)


@query("rrf_fuse", f"WITH {BM25_SQL}, {VECTOR_SQL}, {RRF_SQL.format(k=50)} SELECT id, score, rank FROM final")
def rrf_fuse(spark, sf_dir):
    lexical = _lexical(spark, sf_dir, 50)
    vector = search.vector_topk(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _query_vector(spark, sf_dir), 50)
    return search.rrf_fuse([lexical, vector])


@query("hybrid_search", f"WITH {BM25_SQL}, {VECTOR_SQL}, {RRF_SQL.format(k=8)} SELECT id, score, rank FROM final WHERE rank <= 8")
def hybrid_search(spark, sf_dir):
    return _hybrid(spark, sf_dir, 8)


@query("search_wiki", f"WITH {BM25_SQL}, {VECTOR_SQL}, {RRF_SQL.format(k=8)} SELECT rank, id, source, lang, substr(text, 1, 200) AS snippet FROM final JOIN documents ON doc_id = id WHERE rank <= 8")
def search_wiki(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return F.broadcast(_hybrid(spark, sf_dir, 8)).join(d, F.col("id") == d["doc_id"]).select("rank", "id", "source", "lang", F.substring("text", 1, 200).alias("snippet"))


@query("search_claims", f"WITH {B.CLAIMS_SQL.strip()}, {BM25_SQL}, {VECTOR_SQL}, {RRF_SQL.format(k=8)} SELECT rank, c.claim_id, c.producer, c.source_id, coalesce(string_agg(e.locator || '=' || e.quote, '|' ORDER BY e.pos), '') AS evidence FROM final JOIN claims c ON c.doc_id = id LEFT JOIN evidence e ON e.claim_id = c.claim_id WHERE rank <= 8 GROUP BY ALL")
def search_claims(spark, sf_dir):
    return _claims_with_evidence(spark, sf_dir)


def _claims_with_evidence(spark, sf_dir):
    from quarry.operators import evidence as E

    claims = B.claims(spark, sf_dir)
    # at most k rows on the small side: the claims are filtered in their scan's stage
    found = F.broadcast(_hybrid(spark, sf_dir, 8)).join(claims, F.col("id") == claims["ord"]).select("rank", "claim_id", "producer", "source_id", "supporting_evidence")
    flat = E.normalised_evidence(E.flatten_evidence(found))
    nested = flat.groupBy("claim_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat("locator", F.lit("="), "quote").alias("t")))), lambda x: x["t"]), "|").alias("evidence"))
    return found.join(nested, "claim_id", "left").select("rank", "claim_id", "producer", "source_id", F.coalesce("evidence", F.lit("")).alias("evidence"))


@query("search_postfilter", f"WITH {B.CLAIMS_SQL.strip()}, {BM25_SQL}, {VECTOR_SQL}, {RRF_SQL.format(k=8)} SELECT rank, c.claim_id, c.producer FROM final JOIN claims c ON c.doc_id = id WHERE rank <= 8 AND c.producer = 'pdf'")
def search_postfilter(spark, sf_dir):
    """The producer filter comes after the top k, so fewer than k may be left."""
    return _claims_with_evidence(spark, sf_dir).where("producer = 'pdf'").select("rank", "claim_id", "producer")


@query("hash_embed", "SELECT doc_id, i, round(x / sqrt(norm), 9) AS x FROM (SELECT doc_id, i, x, sum(x * x) OVER (PARTITION BY doc_id) AS norm FROM (SELECT doc_id, i, CAST(('0x' || substr(sha256(text), 2 * i + 1, 2)) AS INTEGER) / CAST(255 AS DOUBLE) * 2 - 1 AS x FROM documents, (SELECT CAST(unnest(range(16)) AS INTEGER) AS i)))")
def hash_embed(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(X.hash_embedding(F.col("text"))).alias("i", "x")).select("doc_id", "i", F.round("x", 9).alias("x"))


@query("cosine_pairs", "WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1) SELECT query_id, vec_id, round(list_cosine_similarity(CAST(q AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 5) AS cosine FROM embeddings, q")
def cosine_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = F.broadcast(e.orderBy("vec_id").limit(1).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")))
    return e.crossJoin(q).select("query_id", "vec_id", F.round(X.cosine(F.col("q"), F.col("embedding")), 5).alias("cosine"))


WALK_SQL = """WITH RECURSIVE {edges}, walk AS (SELECT '{start}' AS node, 0 AS depth UNION SELECT v, depth + 1 FROM walk JOIN links ON u = node WHERE depth < {depth})
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE node <> '{start}' GROUP BY node"""


@query("neighbors_d1", WALK_SQL.format(edges=B.PLACES_SQL, start="n:7", depth=1))
def neighbors_d1(spark, sf_dir):
    return graph.neighbors(B.places(spark, sf_dir), "a", "b", "n:7", 1)


@query("neighbors_d2", WALK_SQL.format(edges=B.PLACES_SQL, start="n:7", depth=2))
def neighbors_d2(spark, sf_dir):
    return graph.neighbors(B.places(spark, sf_dir), "a", "b", "n:7", 2)


LINKS_SQL = B.PATHS_SQL.replace("links AS (", "hrefs AS (").replace("FROM links)", "FROM hrefs)") + ", links AS (SELECT path AS u, target AS v FROM resolved UNION SELECT target, path FROM resolved)"


@query("link_neighbors", WALK_SQL.format(edges=LINKS_SQL, start="the", depth=2))
def link_neighbors(spark, sf_dir):
    return graph.neighbors(B.page_edges(spark, sf_dir), "path", "target", "the", 2)

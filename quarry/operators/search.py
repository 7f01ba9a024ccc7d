"""Lexical, vector and hybrid ranking."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.session import materialise

#: BM25 parameters and the rank constant of fusion: the published defaults.
K1, B, RRF_K = 1.2, 0.75, 60


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf, dl): the inverted index as a table; partition or bucket it by term.

    Terms are counted inside each row, from its sorted words, so no table of (id, term) is
    held or shuffled. Only rows whose id stands more than once meet in an aggregate; those ids
    are written out first, so that the joins with them go by their measured number.
    """
    repeated = materialise(docs.groupBy(F.col(id_col).alias("_twice")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_twice"), "postings-ids")
    same = F.col(id_col).eqNullSafe(F.col("_twice"))
    if not repeated.limit(1).count():
        return _row_postings(docs, id_col, text_col)
    apart = _row_postings(docs.join(repeated, same, "left_anti"), id_col, text_col)
    together = _row_postings(docs.join(repeated, same, "left_semi"), id_col, text_col).groupBy("id", "term", "dl").agg(F.sum("tf").alias("tf"))
    return apart.unionByName(together)


def _row_postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf, dl) of each row by itself: where a term begins among the sorted words, and the next."""
    words = docs.select(F.col(id_col).alias("id"), F.sort_array(X.tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("words"))
    starts = F.filter(F.transform("words", lambda x, i: F.when((i == 0) | (x != F.get("words", i - 1)), i)), lambda i: i.isNotNull())
    begun = words.select("id", "words", F.size("words").alias("n"), starts.alias("starts"))
    counted = F.transform("starts", lambda i, k: F.struct(F.get("words", i).alias("term"), (F.coalesce(F.get("starts", k + 1), F.col("n")) - i).cast("long").alias("tf")))
    return begun.select("id", F.col("n").cast("long").alias("dl"), F.inline(counted)).select("id", "term", "tf", "dl")


def bm25_scores(docs: DataFrame, id_col: str, text_col: str, query: str) -> DataFrame:
    """(id, score) of every document with a query term.

    One map over the texts computes each document's length and its counts of the query's
    terms. Those few numbers are written out, since both the collection figures (one row)
    and the scores come from them; the texts are read and cut into words once.
    """
    terms = sorted({t for t in _query_terms(query)})
    if not terms:
        return docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score")).limit(0)
    words = X.tokens(F.coalesce(F.col(text_col), F.lit("")))
    counted = docs.select(F.col(id_col).alias("id"), words.alias("w")).select(
        "id", F.size("w").cast("long").alias("dl"), *[_occurrences("w", t).alias(f"tf{i}") for i, t in enumerate(terms)]
    )
    counted = materialise(counted, "bm25-counts")
    figures = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), *[F.sum(F.when(F.col(f"tf{i}") > 0, 1).otherwise(0)).alias(f"df{i}") for i in range(len(terms))])
    hit = F.lit(False)
    for i in range(len(terms)):
        hit = hit | (F.col(f"tf{i}") > 0)
    score: Column = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    # one row of collection figures, whatever the data's size
    return counted.where(hit).crossJoin(F.broadcast(figures)).select("id", F.round(score, 6).alias("score"))


def index_tables(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """What lexical search reads: postings, sorted by term so that a scan for a few terms skips
    the other row groups, and the collection's figures (n, avgdl), one row."""
    found = postings(docs, id_col, text_col).repartitionByRange("term", "id").sortWithinPartitions("term", "id")
    length = F.size(X.tokens(F.coalesce(F.col(text_col), F.lit(""))))
    return found, docs.agg(F.count(F.lit(1)).alias("n"), F.avg(length).alias("avgdl"))


def bm25_of_postings(found: DataFrame, figures: DataFrame, query: str) -> DataFrame:
    """(id, score) from stored postings: only rows of the query's terms are read."""
    terms = sorted(set(_query_terms(query)))
    rows = found.where(F.col("term").isin(terms)) if terms else found.limit(0)
    df = rows.groupBy(F.col("term").alias("_t")).agg(F.count(F.lit(1)).alias("df"))
    # one row of figures and a row for each term of the query
    joined = rows.join(F.broadcast(df), F.col("term") == F.col("_t")).crossJoin(F.broadcast(figures))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return joined.groupBy("id").agg(F.round(F.sum(part), 6).alias("score"))


def embedded(docs: DataFrame, id_col: str, text_col: str, embed, batch: int = 64) -> DataFrame:
    """(id, text, vector): texts go to ``embed`` (a list of texts to a list of vectors) in batches,
    on the executors; ids and texts that are null are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch].copy()
                part["vector"] = [[float(x) for x in v] for v in embed(part["text"].tolist())]
                yield part

    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return known.mapInPandas(run, "id string, text string, vector array<float>")


def _occurrences(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda x: x == term))


def _query_terms(query: str) -> list[str]:
    return [t for t in "".join(c if c.isalnum() else " " for c in query.lower()).split() if t]


def ranked(scored: DataFrame, k: int, descending: bool = True) -> DataFrame:
    """The top k with ranks from 1; ties by id. Only k rows meet in the ranking window."""
    order = [F.col("score").desc() if descending else F.col("score").asc(), F.col("id")]
    top = scored.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))


def bm25_topk(docs: DataFrame, id_col: str, text_col: str, query: str, k: int) -> DataFrame:
    return ranked(bm25_scores(docs, id_col, text_col, query), k)


def vector_topk(vectors: DataFrame, id_col: str, vec_col: str, query: DataFrame | list[float], k: int) -> DataFrame:
    """Nearest by L2; ``query`` is a vector or a frame with the one row of it (column ``q``)."""
    if isinstance(query, DataFrame):
        scored = vectors.crossJoin(F.broadcast(query.select("q").limit(1)))
    else:
        scored = vectors.withColumn("q", F.array(*[F.lit(float(x)) for x in query]))
    return ranked(scored.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.round(X.squared_distance(F.col(vec_col), F.col("q")), 6).alias("score")), k, descending=False)


def rrf_fuse(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """(id, score, rank) of ranked lists (id, rank); ties keep first insertion order."""
    parts = [df.select("id", "rank", F.lit(i).alias("list")) for i, df in enumerate(lists)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    fused = union.groupBy("id").agg(F.round(F.sum(1.0 / (k + F.col("rank"))), 9).alias("score"), F.min(F.struct("list", "rank")).alias("first"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc(), F.col("first.list"), F.col("first.rank"))
    return fused.withColumn("rank", F.row_number().over(order).cast("long")).select("id", "score", "rank")


def hybrid_of_index(found: DataFrame, figures: DataFrame, query: str, vectors: DataFrame | None, query_vector: list[float] | None, k: int) -> DataFrame:
    """As ``hybrid``, from stored postings and vectors (id, vector)."""
    lists = [ranked(bm25_of_postings(found, figures, query), k).select("id", "rank")]
    if vectors is not None:
        lists.append(vector_topk(vectors, "id", "vector", query_vector, k).select("id", "rank"))
    return rrf_fuse(lists).where(F.col("rank") <= k)


def hybrid(docs: DataFrame, id_col: str, text_col: str, query: str, vectors: DataFrame | None, vec_id: str, vec_col: str, query_vector, k: int) -> DataFrame:
    """k of each list, fused, k of that; lexical alone if there are no vectors."""
    lists = [bm25_topk(docs, id_col, text_col, query, k).select("id", "rank")]
    if vectors is not None:
        lists.append(vector_topk(vectors, vec_id, vec_col, query_vector, k).select("id", "rank"))
    return rrf_fuse(lists).where(F.col("rank") <= k)

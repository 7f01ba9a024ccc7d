"""The index and its eight query tools; each returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evidence as E
from quarry.operators import graph, search
from quarry.sources import jsonl, sinks

INDEX_VERSION = "1"
EMPTY_ARRAY = "array<string>"
#: What can be searched: name -> (table, id, text).
SEARCHED = {"wiki": ("wiki_pages", "path", "body"), "claim": ("claims", "claim_id", "claim")}


def compile_index(spark: SparkSession, folder: str, kb: str, roots: dict[str, str], embed=None, embed_name: str = "") -> dict[str, int]:
    """Wiki pages and runs (producer -> root folder) into the index tables; row counts.

    Beside the relations the index holds postings and figures for lexical search and, with
    ``embed`` (a list of texts to a list of vectors, run on executors), vector tables.
    """
    pages = jsonl.wiki_pages(spark, kb)
    claims = _all(spark, roots, "claims")
    named = claims.withColumn("source_id", F.coalesce("document_id", "source_id", "run"))
    evidence = E.normalised_evidence(E.flatten_evidence(named.withColumn("supporting_evidence", F.coalesce("supporting_evidence", F.array().cast(jsonl.EVIDENCE)))))
    entities = _all(spark, roots, "entities")
    chunks = _all(spark, roots, "chunks")
    tables = {
        "meta": spark.createDataFrame([("index_schema_version", INDEX_VERSION)], "key string, value string"),
        "wiki_pages": pages.drop("links"),
        "wiki_links": pages.select(F.col("path").alias("from_path"), F.explode("links").alias("to_path")),
        "claims": named.select("claim_id", "producer", "source_id", F.coalesce("claim", F.lit("")).alias("claim"), "claim_type", "confidence"),
        "claim_evidence": evidence,
        "entities": E.merge_entities(entities.select("entity_id", "name", F.coalesce("aliases", F.array().cast(EMPTY_ARRAY)).alias("aliases"), "type", "producer", F.col("run").alias("source_id"), F.struct("producer", "run").alias("ord"))),
        "entity_mentions": entities.select("entity_id", F.explode("mentions").alias("locator"), "producer", F.col("run").alias("source_id")),
        "relations": _all(spark, roots, "relations").select("relation_id", "subject", "predicate", "object", "supporting_claim", "producer", F.col("run").alias("source_id")),
        "chunks": E.chunk_texts(chunks.withColumn("ord", F.monotonically_increasing_id())),
    }
    for name, (source, id_col, text_col) in SEARCHED.items():
        tables[f"{name}_postings"], tables[f"{name}_figures"] = search.index_tables(tables[source], id_col, text_col)
        if embed is not None:
            tables[f"{name}_vectors"] = search.embedded(tables[source], id_col, text_col, embed)
    if embed is not None:
        tables["meta"] = sinks.upsert_meta(tables["meta"], "embedder", embed_name)
    return sinks.build_index(spark, folder, tables, [kb, *roots.values()])


def _all(spark: SparkSession, roots: dict[str, str], kind: str) -> DataFrame:
    frames = [jsonl.run_rows(spark, root, producer, kind) for producer, root in roots.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class Index:
    """Tools over a compiled index; without vectors or an embedder, search is lexical (``degraded``)."""

    def __init__(self, spark: SparkSession, folder: str, embed=None):
        self.tables = sinks.read_index(spark, folder)
        self.spark, self.embed = spark, embed

    @property
    def degraded(self) -> bool:
        return self.embed is None or not all(f"{name}_vectors" in self.tables for name in SEARCHED)

    def _search(self, name: str, query: str, k: int) -> DataFrame:
        vectors = None if self.degraded else self.tables[f"{name}_vectors"]
        vector = None if vectors is None else [float(x) for x in self.embed([query])[0]]
        return search.hybrid_of_index(self.tables[f"{name}_postings"], self.tables[f"{name}_figures"], query, vectors, vector, k)

    def search_wiki(self, query: str, k: int = 8) -> DataFrame:
        found, pages = self._search("wiki", query, k), self.tables["wiki_pages"]
        return found.join(pages, found["id"] == pages["path"]).select("rank", "path", "title", "type", "status", F.substring("body", 1, 200).alias("snippet"))

    def read_page(self, path: str) -> DataFrame:
        return self.tables["wiki_pages"].where(F.col("path") == path).select("path", "body", "frontmatter_json")

    def search_claims(self, query: str, k: int = 8, producer: str | None = None) -> DataFrame:
        """Claims with nested evidence; the producer filter comes after the top k."""
        found = self._search("claim", query, k)
        claims, ev = self.tables["claims"], self.tables["claim_evidence"]
        nested = ev.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("pos", "producer", "source_id", "locator", "page", "url", "quote"))).alias("evidence"))
        joined = found.join(claims, found["id"] == claims["claim_id"]).join(nested, "claim_id", "left")
        rows = joined.select("rank", "claim_id", "producer", "source_id", "claim", "claim_type", "confidence", "evidence")
        return rows.where(F.col("producer") == producer) if producer else rows

    def get_entity(self, entity: str) -> DataFrame:
        """By id or, in any case, by name, the first by producer and source; with its mentions and
        the relations it is an end of."""
        e = self.tables["entities"].where((F.col("entity_id") == entity) | (F.lower("name") == entity.lower()))
        one = e.orderBy("producer", "source_id").limit(1)
        mentions = self.tables["entity_mentions"].join(F.broadcast(one.select("entity_id")), "entity_id").agg(F.array_sort(F.collect_list("locator")).alias("mentions"))
        ends = one.select(F.col("entity_id").alias("_e"))
        r = self.tables["relations"]
        # two equi-joins, not one on OR; a relation of an entity with itself comes once
        near = r.join(F.broadcast(ends), F.col("subject") == F.col("_e")).unionByName(r.where("not subject <=> object").join(F.broadcast(ends), F.col("object") == F.col("_e")))
        relations = near.agg(F.array_sort(F.collect_list(F.struct("relation_id", "subject", "predicate", "object"))).alias("relations"))
        return one.crossJoin(mentions).crossJoin(relations).select("entity_id", "name", "type", "aliases", "mentions", "relations")

    def neighbors(self, entity: str, depth: int = 1) -> DataFrame:
        return graph.neighbors(self.tables["relations"], "subject", "object", entity, depth).orderBy("depth", "node")

    def link_neighbors(self, path: str, depth: int = 1) -> DataFrame:
        return graph.neighbors(self.tables["wiki_links"], "from_path", "to_path", path, depth).orderBy("depth", "node")

    def get_sources(self, page: str | None = None, claim: str | None = None) -> DataFrame:
        if page is not None:
            return self.read_page(page).select(F.col("path").alias("page"), *[F.get_json_object("frontmatter_json", f"$.{k}").alias(k) for k in ("source", "source_docs", "resource")])
        return self.tables["claim_evidence"].where(F.col("claim_id") == claim).select("producer", "source_id", "url").distinct()

    def find_contradictions(self) -> DataFrame:
        return E.contradiction_candidates(self.tables["relations"], self.tables["wiki_pages"])

    def compose_dossier(self, claim_ids: list[str] | None = None, query: str | None = None, k: int = 12) -> DataFrame:
        if claim_ids is None:
            ids = self._search("claim", query or "", k).select(F.col("id").alias("claim_id"), F.col("rank").alias("pos"))
        else:
            ids = self.spark.createDataFrame(list(zip(claim_ids, range(len(claim_ids)))), "claim_id string, pos long")
        return E.dossier(ids, self.tables["claims"], self.tables["claim_evidence"], self.tables["chunks"]).orderBy("pos")

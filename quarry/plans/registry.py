"""Every registered query of the engine's own operators, with its SQL.

A query takes (spark, sf_dir) and returns a frame over the driver's whole tables; its SQL,
where there is one, says the same for DuckDB. Queries add themselves with ``query``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["hybrid_search"](spark, sf_dir)


from quarry.plans import curation_queries, document_queries, evaluation_queries, evidence_queries, search_queries, structure_queries  # noqa: E402, F401  they register themselves

"""Bounded undirected walks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialise


def symmetric(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Both directions of every edge with two ends: an equi-join then serves either end."""
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return known.select(F.col(a).alias("u"), F.col(b).alias("v")).union(known.select(F.col(b), F.col(a)))


def neighbors(edges: DataFrame, a: str, b: str, start: str, depth: int = 1) -> DataFrame:
    """(node, depth) of all nodes within ``depth`` hops, with the least depth; not the start.

    A join a hop; each frontier is written out, without what was seen before.
    """
    spark = edges.sparkSession
    links = symmetric(edges, a, b).distinct()
    seen = spark.createDataFrame([(start, 0)], "node string, depth int")
    frontier = seen
    for hop in range(1, depth + 1):
        reached = frontier.join(links, frontier["node"] == links["u"]).select(F.col("v").alias("node")).distinct()
        frontier = materialise(reached.join(seen, "node", "left_anti").withColumn("depth", F.lit(hop)), "walk")
        seen = seen.unionByName(frontier)
    return seen.where(F.col("node") != start)

"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked node; the root is the component's smallest id.

    A round gives each node the smallest label among its neighbours', then the label of
    that label; labels only fall, so unchanged labels end the loop. Every round is written
    out, so plans don't grow and a lost executor costs one round at most. Degrees may be
    skewed: minima are pre-aggregated and the joins have one row a node on the other side.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    edges = materialise(edges.union(edges.select("v", "u")).distinct(), "cc-edges")
    labels = materialise(edges.groupBy(F.col("u").alias("id")).agg(F.least(F.col("id"), F.min("v")).alias("root")), "cc-labels")
    while True:
        heard = edges.join(labels.select(F.col("id").alias("v"), "root"), "v").groupBy(F.col("u").alias("id")).agg(F.min("root").alias("heard"))
        lower = labels.join(heard, "id").select("id", "root", F.least("root", "heard").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("root").alias("jumped"))
        moved = materialise(lower.join(jump, "low").select("id", F.least("low", "jumped").alias("root"), (F.least("low", "jumped") < F.col("root")).alias("changed")), "cc-round")
        labels = moved.select("id", "root")
        if not moved.where("changed").limit(1).count():
            return labels

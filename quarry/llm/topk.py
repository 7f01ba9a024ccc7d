"""Exact top-k inner products by best-first search in paged metric trees.

Vectors become integers floor(256 * x). For inner products a metric is needed: each vector
gets one more coordinate, sqrt(M - |v|^2) with M the largest squared norm, and a query gets
0 there; then squared distance = |q|^2 + M - 2 * score, so the nearest are those of the
highest score. Bounds are computed in doubles, on vectors scaled by a power of two so that
no square overflows, with a margin for rounding. The scores that rank are exact integers:
doubles where no sum of products can reach 2**53, Python's integers where one can.

Three levels. A bounded sample of vectors (``PIVOTS``) are the root's routing objects;
every vector goes to the nearest, and a routing object's vectors are dealt, in rings by
their distance to it, into shards of about ``SHARD`` vectors with known nearest and
farthest distance. Within a shard a task builds an M-tree: pages (leaf nodes) of
``PAGE`` entries, each with its routing object, covering radius, distance to the parent
routing object, and the entries' stored distances to the page's routing object.

A query first searches its home shard, best page first; its k-th best score then rules out
every shard whose ring the triangle inequality keeps farther away, and it visits the
others with that bound; the rings are read in passes of ``DIRECTORY``. In a shard,
|d(q, parent) - d(page, parent)| - radius decides without a distance computation whether a
page can matter, then d(q, page) - radius, then |d(q, page) - d(entry, page)| whether an
entry can.

Equal vectors are searched once: of each distinct vector the k + 1 smallest ids stand for
it, which is all that can be in any answer. Queries meet shards in blocks of ``BLOCK``.

Results by case: null vectors, or those with null or non-finite components (256-fold, too),
and rows with a null id take no part; a score beyond 64 bits ranks by its true value and is
given as the nearest long; shorter vectors count as padded with zeros; of rows with the same
id the smallest vector stands; ties go to the smaller id; fewer than k candidates give
all; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialise

#: Routing objects of the root: one for each SHARD vectors, at most PIVOTS; the distinct
#: vectors with the smallest hashes.
PIVOTS = 256
SHARD, PAGE, BLOCK = 8_192, 64, 2_048
#: Shards whose rings one pass of routing holds: about 40 bytes each.
DIRECTORY = 131_072
QUERY_STEP = 50
SCALE = 256
#: Rounding of a bound is under this share of the longest vector (plus one).
MARGIN = 1e-6
#: Doubles add integers exactly below this.
EXACT = float(1 << 53)
#: Added to scores beyond that, so that their decimal digits sort like numbers.
OFFSET, DIGITS = 10**640, 641
#: What stands for the negated id at a place in a heap that holds a bound.
NOBODY = -(1 << 64)


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): integer components, as doubles, of the rows that take part, one row an id."""
    scaled = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double") * SCALE).alias("y"))
    usable = F.forall("y", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    # from 2**53 on a double is an integer; floor() would force it into a long
    whole = F.transform("y", lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y))
    return scaled.where(usable).select("id", whole.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def sortable(score: int) -> str:
    return str(score + OFFSET).zfill(DIGITS)


def clamped(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def lifted(v: np.ndarray, most: float) -> np.ndarray:
    """Data vectors with the coordinate that makes inner products a metric."""
    return np.hstack([v, np.sqrt(np.maximum(0.0, most - (v * v).sum(1)))[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))


class MTree:
    """A shard's pages under one routing object. Points are lifted; ``unit`` is what they were
    divided by. With ``whole`` (the vectors as integers) scores are Python's integers."""

    def __init__(self, points: np.ndarray, ids: list[np.ndarray], parent: np.ndarray, most: float, unit: float = 1.0, whole: list[list[int]] | None = None, page: int = PAGE):
        self.points, self.ids, self.most, self.unit, self.whole = points, ids, most, unit, whole
        self.margin = MARGIN * (1 + math.sqrt(most))
        to_parent = distances(points, parent[None])[:, 0]
        self.pages: list[np.ndarray] = []
        todo = [np.argsort(to_parent, kind="stable")]
        while todo:  # split by the two farthest-apart of a few, until a page holds the rest
            own = todo.pop()
            if len(own) <= page:
                self.pages.append(own)
                continue
            first = points[own[-1]][None]
            second = points[own[int(distances(points[own], first)[:, 0].argmax())]][None]
            lean = distances(points[own], first)[:, 0] - distances(points[own], second)[:, 0]
            order = own[np.argsort(lean, kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        middle = [own[int(distances(points[own], points[own].mean(0)[None])[:, 0].argmin())] for own in self.pages]
        self.routing = points[middle]
        self.parent_distance = to_parent[middle]
        self.entry_distance = [distances(points[own], points[m][None])[:, 0] for own, m in zip(self.pages, middle)]
        self.radius = np.array([d.max() for d in self.entry_distance])

    def scores(self, near: np.ndarray, q: np.ndarray, whole: list[int] | None) -> list[int] | np.ndarray:
        if self.whole is None or whole is None:
            return self.points[near, :-1] @ q[:-1]
        return [sum(map(operator.mul, self.whole[i], whole)) for i in near]

    def search(self, q: np.ndarray, to_parent: float, query_id: int, k: int, best: list[tuple[int, int]], whole: list[int] | None = None) -> list[tuple[int, int]]:
        """The best (score, -id) among ``best`` and the tree's vectors; ``best`` is a heap of at most k."""
        square = float(q @ q)
        far = self._reach(best, k, square)
        bound = np.abs(to_parent - self.parent_distance) - self.radius
        alive = np.flatnonzero(bound <= far + self.margin)
        if not len(alive):
            return best
        to_page = distances(q[None], self.routing[alive])[0]
        queue = [(float(max(d - self.radius[p], 0.0)), int(p), float(d)) for p, d in zip(alive, to_page)]
        heapq.heapify(queue)
        while queue:
            least, p, d = heapq.heappop(queue)
            if least > far + self.margin:
                break
            own = self.pages[p]
            near = own[np.abs(d - self.entry_distance[p]) <= far + self.margin]
            if not len(near):
                continue
            scores = self.scores(near, q, whole)
            if len(best) >= k:
                enough = np.array([s >= best[0][0] for s in scores]) if isinstance(scores, list) else scores >= best[0][0]
                near, scores = near[enough], [s for s, e in zip(scores, enough) if e] if isinstance(scores, list) else scores[enough]
            for at, score in zip(near, scores):
                for i in self.ids[at]:
                    if i == query_id:
                        continue
                    entry = (int(score), -int(i))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            far = self._reach(best, k, square)
        return best

    def _reach(self, best: list[tuple[int, int]], k: int, square: float) -> float:
        """The distance of the k-th best: nothing farther can enter, equal distance can (ties)."""
        return reach(square, self.most, best[0][0], self.unit) if len(best) >= k else float("inf")


def reach(square: float, most: float, score: int, unit: float) -> float:
    """The distance, in units, at which a score is ``score``; scores stay under 1e300 times a unit's square."""
    share = score / int(unit) ** 2 if unit > 1 else score
    return math.sqrt(max(0.0, square + most - 2 * float(share)))


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by ``step``."""
    spark = vectors.sparkSession
    points = materialise(quantised(vectors, id_col, vec_col), "topk-points")
    width, largest = points.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0.0))).first()
    # squares of components stay exact under 2**26; beyond, bounds use a power of two as unit
    unit = 1.0 if largest < 1 << 26 else 2.0 ** math.frexp(largest)[1]
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / unit) * (x / unit))
    most = float(points.agg(F.coalesce(F.max(norm), F.lit(0.0))).first()[0])
    exact = unit > 1 or most >= EXACT / 2
    margin = MARGIN * (1 + math.sqrt(most))
    # of each distinct vector, the k + 1 smallest ids; the rank limit is applied before the shuffle too
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = points.withColumn("_n", smallest).where(F.col("_n") <= k + 1)
    classes = materialise(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "topk-classes")
    wanted = min(PIVOTS, max(1, classes.count() // SHARD))
    sample = classes.orderBy(F.xxhash64("v"), "v").limit(wanted).select("v").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = lifted(matrix([np.array(r.v, dtype=float) for r in sample], width) / unit, most)
    shared = spark.sparkContext.broadcast(pivots)

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = distances(lifted(matrix(list(batch["v"]), width) / unit, most), shared.value)
                batch["pivot"] = d.argmin(1)
                batch["distance"] = d.min(1)
                yield batch

    placed = materialise(classes.mapInPandas(assigned, "v array<double>, ids array<long>, pivot int, distance double"), "topk-placed")
    # shards of a pivot: rings of about SHARD vectors by approximate quantiles of the distance
    spans = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("distance", F.array(*[F.lit(i / 64) for i in range(1, 64)]), 10_000).alias("marks"))
    pieces = F.least(F.lit(64), F.ceil(F.col("n") / SHARD)).cast("int")
    cuts = spans.select(F.col("pivot").alias("p"), F.col("n"), F.transform(F.sequence(F.lit(1), pieces), lambda i: F.when(i < pieces, F.element_at("marks", F.floor(i * 64 / pieces).cast("int"))).otherwise(F.lit(float("inf")))).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda c: c < F.col("distance")))
    # a ring can still be too full (many at one distance, or more than 64 shards): those are dealt by hash
    ringed = placed.join(cuts, F.col("pivot") == F.col("p")).withColumn("ring", ring)
    full = ringed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("m")).withColumnsRenamed({"pivot": "p2", "ring": "r2"})
    salted = ringed.join(full, (F.col("pivot") == F.col("p2")) & (F.col("ring") == F.col("r2"))).withColumn("salt", F.pmod(F.xxhash64("v"), F.ceil(F.col("m") / (2 * SHARD)).cast("long")).cast("int"))
    sharded = materialise(salted.select("v", "ids", "distance", "pivot", F.concat_ws("-", "pivot", "ring", "salt").alias("shard")), "topk-sharded")
    directory = materialise(sharded.groupBy("shard", "pivot").agg(F.min("distance").alias("inner"), F.max("distance").alias("outer")), "topk-directory")
    passes = max(1, -(-directory.count() // DIRECTORY))

    def query_matrix(batch: pd.DataFrame) -> np.ndarray:
        return np.hstack([matrix(list(batch["v"]), width) / unit, np.zeros((len(batch), 1))])

    def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries with the shard of their own vector, and the distance to its routing object."""
        for batch in batches:
            if len(batch):
                batch["to_parent"] = np.sqrt(np.maximum(0.0, ((query_matrix(batch) - shared.value[batch["pivot"]]) ** 2).sum(1)))
                yield batch[["shard", "id", "v", "bound", "to_parent", "pivot"]]

    def routed_in(part: int) -> DataFrame:
        """Bounded queries with every other shard, of one pass over the directory, that can matter."""
        rows = directory.where(F.pmod(F.xxhash64("shard"), F.lit(passes)) == part).orderBy("pivot", "shard").collect()
        entries = spark.sparkContext.broadcast(([r.shard for r in rows], np.array([r.pivot for r in rows], dtype=np.int64), np.array([r.inner for r in rows]), np.array([r.outer for r in rows])))

        def routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, of, inner, outer = entries.value
            for batch in batches:
                if not len(batch):
                    continue
                q = query_matrix(batch)
                d = distances(q, shared.value)
                out = []
                for i, row in enumerate(batch.itertuples(index=False)):
                    bound = None if pd.isna(row.bound) else row.bound
                    far = float("inf") if bound is None else reach(float(q[i] @ q[i]), most, decoded(bound), unit)
                    away = np.maximum(d[i, of] - outer, inner - d[i, of])
                    out += [(names[j], row.id, row.v, bound, float(d[i, of[j]]), int(of[j])) for j in np.flatnonzero(away <= far + margin) if names[j] != row.home]
                yield pd.DataFrame(out, columns=["shard", "id", "v", "bound", "to_parent", "pivot"]).astype({"bound": "object" if exact else "Int64"})

        return bounded.mapInPandas(routes, route_schema)

    key_type = "string" if exact else "long"
    route_schema = f"shard string, id long, v array<double>, bound {key_type}, to_parent double, pivot int"
    decoded = lambda key: int(key) - OFFSET if exact else int(key)

    def searched(key: tuple, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(entries):
            pivot = shared.value[int(queries["pivot"].iloc[0])]
            integers = lambda v: list(map(int, v))
            tree = MTree(lifted(matrix(list(entries["v"]), width) / unit, most), list(entries["ids"]), pivot, most, unit, list(map(integers, entries["v"])) if exact else None)
            for row in queries.itertuples(index=False):
                q = np.append(matrix([row.v], width)[0] / unit, 0.0)
                # k places held at the bound: only what reaches it can enter
                best = [] if pd.isna(row.bound) else [(decoded(row.bound) - 1, NOBODY)] * k
                found = tree.search(q, row.to_parent, row.id, k, best, integers(row.v) if exact else None)
                out += [(row.id, -i, sortable(score) if exact else score, clamped(score)) for score, i in found if i != NOBODY]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "key", "score"])

    def visit(routed: DataFrame) -> DataFrame:
        """Search routed queries in their shards, in blocks of at most about BLOCK queries."""
        routed = materialise(routed, "topk-routes")
        blocks = routed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        asked = routed.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")).select("shard", "block", "id", "v", "bound", "to_parent", "pivot")
        stored = sharded.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("shard", "block", "v", "ids")
        return asked.groupBy("shard", "block").cogroup(stored.groupBy("shard", "block")).applyInPandas(searched, f"query_id long, vec_id long, key {key_type}, score long")

    queries = points.where(F.col("id") % step == 0)
    order = Window.partitionBy("query_id").orderBy(F.col("key").desc(), "vec_id")
    own = queries.join(sharded.select(F.col("v").alias("own_v"), "shard", "pivot"), F.col("v") == F.col("own_v")).select("id", "v", "shard", "pivot", F.lit(None).cast(key_type).alias("bound"))
    own = materialise(own, "topk-queries")
    home = materialise(visit(own.mapInPandas(at_home, route_schema)), "topk-home")
    bounds = home.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("key")).alias("bound"))
    bounded = own.drop("bound").join(bounds, F.col("id") == F.col("query_id"), "left").select("id", "v", "bound", F.col("shard").alias("home"))
    found = home
    for part in range(passes):
        found = found.unionByName(visit(routed_in(part)))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

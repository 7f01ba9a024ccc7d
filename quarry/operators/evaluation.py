"""Recall, coverage, intervals, resampling and promotion gates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X


def recall(reference: DataFrame, hits: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Reference rows recalled, per group; null without reference rows. Keys are compared whole,
    so equal ids of different groups don't credit each other."""
    marked = reference.join(hits.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return marked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("recalled")).withColumn("recall", F.round(F.try_divide("recalled", "n"), 6))


def bait_rejection(quotes: DataFrame, by: str) -> DataFrame:
    """(sources, bait_rejection): the mean over ``by`` of the share of claims none of whose quotes
    stands in the text that the bait was copied from. Quotes are (claim_id, by, quote,
    chunk_text); the empty quote stands everywhere."""
    held = quotes.groupBy("claim_id", by).agg(F.bool_and(~F.contains("chunk_text", F.col("quote"))).alias("held"))
    per = held.groupBy(by).agg(F.avg(F.when(F.col("held"), 1.0).otherwise(0.0)).alias("r"))
    return per.agg(F.count(F.lit(1)).alias("sources"), F.round(F.avg("r"), 6).alias("bait_rejection"))


def coverage(cited: Column, allowed: Column, floor: float = 0.8) -> tuple[Column, Column, Column]:
    """(share of allowed ids cited, ids cited that aren't allowed, passed): under four allowed
    ids all must be cited, from four on a share of ``floor``."""
    hit = F.size(F.array_intersect(cited, allowed))
    share = F.try_divide(hit, F.size(allowed))
    foreign = F.size(F.array_except(cited, allowed))
    enough = F.when(F.size(allowed) < 4, hit == F.size(allowed)).otherwise(F.coalesce(share >= floor, F.lit(True)))
    return share, foreign, enough & (foreign == 0)


def harmonic(a: Column, b: Column) -> Column:
    return F.when((a + b) > 0, 2 * a * b / (a + b))


def summary(rows: DataFrame, by: str, value: str) -> DataFrame:
    """n, mean, median (of the two middle values), least and most."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.percentile(value, 0.5).alias("median"), F.min(value).cast("long").alias("least"), F.max(value).cast("long").alias("most"))


def similar_vectors(produced: DataFrame, reference: DataFrame, threshold: float, block: int = 2048) -> DataFrame:
    """Reference ids with a produced vector of cosine ``threshold`` or more.

    Both sides (id, v) are dealt into blocks by id; each pair of blocks is one matrix
    product in a task, and a block of references yields at most itself.
    """
    n_produced = max(1, -(-produced.count() // block))
    n_reference = max(1, -(-reference.count() // block))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    p = produced.select("id", "v", own(n_produced).alias("pb")).withColumn("rb", every(n_reference))
    r = reference.select("id", "v", own(n_reference).alias("rb")).withColumn("pb", every(n_produced))

    def unit(v: pd.Series) -> np.ndarray:
        m = np.stack([np.asarray(x, dtype=float) for x in v])
        size = np.sqrt((m * m).sum(1))[:, None]
        return np.divide(m, size, out=np.zeros_like(m), where=size > 0)

    def alike(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": pd.Series(dtype="int64")})
        return b.loc[(unit(b["v"]) @ unit(a["v"]).T >= threshold).any(1), ["id"]]

    return p.groupBy("pb", "rb").cogroup(r.groupBy("pb", "rb")).applyInPandas(alike, "id long").distinct()


def bootstrap_means(rows: DataFrame, by: str, id_col: str, value: str, replicates: int = 200, seed: int = 13) -> DataFrame:
    """(by, mean, low, high, significant): a Poisson bootstrap of the mean, one pass.

    A row's weight in a replicate is a Poisson(1) draw from a hash of (seed, replicate, id),
    so reruns and partitionings agree; sums are pre-aggregated per replicate. The interval
    takes the sorted replicate means at int(0.025 B) and min(int(0.975 B), B - 1).
    """
    u = F.pmod(F.xxhash64(F.lit(seed), "rep", id_col), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    # cumulative Poisson(1) probabilities
    steps, p, total = [], float(np.exp(-1)), 0.0
    for k in range(12):
        total += p
        steps.append(total)
        p /= k + 1
    weight = F.lit(0)
    for s in steps:
        weight = weight + F.when(F.col("u") > s, 1).otherwise(0)
    drawn = rows.select(by, id_col, F.col(value).cast("double").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep")).withColumn("u", u).withColumn("w", weight)
    means = drawn.groupBy(by, "rep").agg(F.try_divide(F.sum(F.col("w") * F.col("x")), F.sum("w")).alias("m"))
    low, high = int(0.025 * replicates), min(int(0.975 * replicates), replicates - 1)
    ordered = means.groupBy(by).agg(F.array_sort(F.collect_list("m")).alias("ms"))
    base = rows.groupBy(F.col(by).alias("_by")).agg(F.avg(F.col(value).cast("double")).alias("mean"))
    found = ordered.join(base, F.col(by).eqNullSafe(F.col("_by")))
    bounds = found.select(by, "mean", F.get("ms", F.lit(low)).alias("low"), F.get("ms", F.lit(high)).alias("high"))
    return bounds.withColumn("significant", (F.col("low") > 0) | (F.col("high") < 0))


def mt_bootstrap(values: list[float], replicates: int, seed: int) -> tuple[float, float, float, bool]:
    """The same interval with Python's generator, for a bounded list on the driver."""
    import random

    if not values:
        return 0.0, 0.0, 0.0, False
    rng, n = random.Random(seed), len(values)
    means = sorted(sum(values[rng.randrange(n)] for _ in range(n)) / n for _ in range(replicates))
    low, high = means[int(0.025 * replicates)], means[min(int(0.975 * replicates), replicates - 1)]
    return sum(values) / n, low, high, low > 0 or high < 0


def paired_deltas(candidate: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """(key, delta): +1 if only the candidate has it, -1 if only the baseline, 0 if both."""
    c, b = candidate.select(F.col(key).alias("kc")), baseline.select(F.col(key).alias("kb"))
    delta = F.when(F.col("kb").isNull(), 1).when(F.col("kc").isNull(), -1).otherwise(0)
    return c.join(b, F.col("kc") == F.col("kb"), "full").select(F.coalesce("kc", "kb").alias(key), delta.alias("delta"))


def promotion_gate(complete: Column, gate_pass: Column, recall_low: Column, bait: Column, atomicity: Column) -> Column:
    """The first failing gate's exit code, in this order; 0 if all hold."""
    return F.when(~complete, 6).when(~gate_pass, 2).when(~recall_low, 3).when(~bait, 4).when(~atomicity, 5).otherwise(0)


def compare_reports(current: DataFrame, previous: DataFrame, key: str, metric: str, tolerance: float = 0.03) -> DataFrame:
    """(key, previous, current, regression): a drop beyond the tolerance, or a value gone."""
    c = current.select(F.col(key).alias("k"), F.col(metric).alias("cur"))
    joined = previous.select(F.col(key), F.col(metric).alias("previous")).join(c, F.col(key) == F.col("k"), "left")
    gone = F.col("previous").isNotNull() & F.col("cur").isNull()
    return joined.select(key, "previous", F.col("cur").alias("current"), F.coalesce(gone | (F.col("previous") - F.col("cur") > tolerance), F.lit(False)).alias("regression"))


def flake_rates(runs: DataFrame, by: str, order: str, passed: Column, error: str) -> DataFrame:
    """(by, runs, passes, rate, low, high, errors): pass rates with Wilson bounds and the first
    three errors; only three rows a group are ever gathered."""
    from pyspark.sql import Window

    rates = runs.groupBy(by).agg(F.count(F.lit(1)).alias("runs"), F.count(F.when(passed, 1)).alias("passes"))
    low, high = X.wilson(F.col("passes"), F.col("runs"))
    failed = runs.where(~passed).select(F.col(by).alias("b"), F.col(order).alias("o"), F.col(error).alias("e"))
    first = failed.withColumn("n", F.row_number().over(Window.partitionBy("b").orderBy("o"))).where("n <= 3")
    errors = first.groupBy("b").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "e"))), lambda x: x["e"]), "|").alias("errors"))
    return rates.join(errors, F.col(by) == F.col("b"), "left").select(by, "runs", "passes", F.round(F.col("passes") / F.col("runs"), 6).alias("rate"), F.round(low, 9).alias("low"), F.round(high, 9).alias("high"), F.coalesce("errors", F.lit("")).alias("errors"))


def flattened_history(reports: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """(key, metric, value): a report's wide row as one row a metric."""
    pairs = F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("double") for m in metrics]))
    return reports.select(key, F.explode(pairs).alias("metric", "value"))

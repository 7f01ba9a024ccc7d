"""Verdicts on contradiction candidates, records and their manifests."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICTS = ("contradiction", "not_contradiction", "unclear")


def valid_verdicts(replies: DataFrame, candidates: DataFrame, verdicts: tuple[str, ...] = VERDICTS) -> DataFrame:
    """The first valid reply of each known key, by reply order.

    Valid: a known verdict, a rationale that isn't blank, and only relation ids of the
    candidate's own. Replies (key, ord, verdict, relation_ids, rationale); candidates
    (key, relation_ids).
    """
    own = candidates.select("key", F.col("relation_ids").alias("own"))
    sound = F.col("verdict").isin(*verdicts) & (F.trim(F.coalesce("rationale", F.lit(""))) != "") & (F.size(F.array_except("relation_ids", "own")) == 0)
    return replies.join(own, "key").where(sound).groupBy("key").agg(F.min_by(F.struct("verdict", "relation_ids", "rationale", "ord"), "ord").alias("r")).select("key", "r.*")


def verdict_score(expected: Column, given: Column) -> Column:
    """1 for the expected verdict, a half for 'unclear', else 0; no reply is 0."""
    return F.when(given == expected, 1.0).when(given == "unclear", 0.5).otherwise(0.0)


def manifest_counts(records: DataFrame, by: str, accepted: Column) -> DataFrame:
    """(by, accepted, rejected, acceptance_rate)."""
    g = records.groupBy(by).agg(F.count(F.when(accepted, 1)).alias("accepted"), F.count(F.when(~F.coalesce(accepted, F.lit(False)), 1)).alias("rejected"))
    return g.withColumn("acceptance_rate", F.round(F.try_divide("accepted", F.col("accepted") + F.col("rejected")), 6))


def generator_digests(records: DataFrame, attribution: DataFrame, amount: str) -> DataFrame:
    """(generator, total): amounts by the generator of each locator, 'unknown' for none."""
    named = records.join(attribution.select("locator", "generator"), "locator", "left")
    return named.groupBy(F.coalesce("generator", F.lit("unknown")).alias("generator")).agg(F.sum(amount).alias("total"))


def schema_versions(rows: DataFrame, declared: str, current: str) -> DataFrame:
    """Rows whose declared version isn't the current one; a missing version is '(none)'."""
    return rows.withColumn("declared", F.coalesce(declared, F.lit("(none)"))).where(F.col("declared") != current)


def conversation_record(system: Column, user: Column, assistant: Column) -> Column:
    """The three messages of a training record."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(message("system", system), message("user", user), message("assistant", assistant))


def merged_bait(records: DataFrame, bait: DataFrame) -> DataFrame:
    """Records (locator, body JSON) with their claims replaced by reviewed ones (JSON) where there
    are any; the body's other fields stay. A body that is no object becomes one of claims alone."""

    @F.pandas_udf("string")
    def replaced(body: pd.Series, claims: pd.Series) -> pd.Series:
        def one(text: str | None, new: str) -> str:
            try:
                old = json.loads(text or "")
            except ValueError:
                old = None
            return json.dumps((old if isinstance(old, dict) else {}) | {"claims": json.loads(new)}, ensure_ascii=False, separators=(",", ":"))

        return pd.Series([t if c is None else one(t, c) for t, c in zip(body, claims)])

    reviewed = bait.select("locator", F.col("claims").alias("_claims"))
    return records.join(reviewed, "locator", "left").select("locator", replaced("body", "_claims").alias("body"))


def instruction_pool(templates: DataFrame, topics: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n of all template and topic pairs (both small fixed lists), in hash order."""
    pairs = templates.join(F.broadcast(topics), F.lit(True)).withColumn("o", F.sha2(F.concat_ws("|", F.lit(str(seed)), "template", "topic"), 256))
    return pairs.orderBy("o").limit(n).select("template", "topic", F.replace("template", F.lit("{}"), F.col("topic")).alias("prompt"))

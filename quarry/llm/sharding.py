"""Sharding by a Feistel permutation of global row numbers, with cycle walking.

Every row gets a global number (its place in the order of a hash of its content), the
permutation maps the number to a position, and shard and slot are that position's
remainder and quotient by the shard count. Shard sizes differ by one row at most, slots
have no gaps, and place(n) can be computed for any row number without looking at data.

The permutation works on pairs (left < a, right < b) with a * b >= n and a near sqrt(n).
Points from n up to a * b are outside; a row landing there is walked on (permuted again)
until it is inside. How many steps the longest walk takes is computed exactly on the
driver from the at most a outside points, so the columns hold just that many steps.

Only DataFrame functions; no Python runs on executors. Results by case: a null text
counts as no bytes (size 8) with the CRC of the empty text; a null id is a value like any
other; equal rows are told apart by a repeat number, so each has a place of its own and
which of them has which is immaterial; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.prefix import bucket_count, running_offset
from quarry.session import materialise

#: A prime just under 2**31: products of two residues fit a signed 64-bit integer.
PRIME = 2_147_483_629
ROUNDS = 6
#: Repeats of one row that unfold together.
PIECE = 65_536


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three residues per round, from a plain multiplicative generator."""
    state, keys = seed % (PRIME - 1) + 1, []
    for _ in range(rounds):
        key = []
        for _ in range(3):
            state = (state * 48_271 + 11) % PRIME
            key.append(state + 1)
        keys.append(tuple(key))
    return keys


def halves(n: int) -> tuple[int, int]:
    """Sizes a, b of the two halves: a * b >= n, fewer than a points too many."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def mixed(x, key: tuple[int, int, int]):
    """Round function on a residue; x is an int or a Column, the arithmetic is the same."""
    v = (x + key[0]) % PRIME
    v = (v * v + key[1]) % PRIME
    return (v * ((v + key[2]) % PRIME) + x) % PRIME


def permuted(x: int, a: int, b: int, keys: list[tuple[int, int, int]]) -> int:
    """One application of the permutation of 0 .. a*b-1."""
    left, right = x // b, x % b
    for i, key in enumerate(keys):
        if i % 2:
            right = (right + mixed(left, key)) % b
        else:
            left = (left + mixed(right, key)) % a
    return left * b + right


def unpermuted(x: int, a: int, b: int, keys: list[tuple[int, int, int]]) -> int:
    left, right = x // b, x % b
    for i, key in reversed(list(enumerate(keys))):
        if i % 2:
            right = (right - mixed(left, key)) % b
        else:
            left = (left - mixed(right, key)) % a
    return left * b + right


def place(number: int, n: int, seed: int) -> int:
    """The position of a row number among n rows, computed alone."""
    (a, b), keys = halves(n), round_keys(seed)
    x = permuted(number, a, b, keys)
    while x >= n:
        x = permuted(x, a, b, keys)
    return x


def longest_walk(n: int, seed: int) -> int:
    """Steps beyond the first that some row needs; looks at the outside points only."""
    (a, b), keys = halves(n), round_keys(seed)
    at, steps = [y for y in range(n, a * b) if unpermuted(y, a, b, keys) < n], 0
    while at:
        at = [y for y in (permuted(x, a, b, keys) for x in at) if y >= n]
        steps += 1
    return steps


def _permuted_column(df: DataFrame, at: str, n: int, a: int, b: int, keys: list[tuple[int, int, int]], walk: bool) -> DataFrame:
    """The same rounds as columns, one projection a round so that no expression is doubled."""
    df = df.withColumn("_l", F.expr(f"{at} div {b}L")).withColumn("_r", F.expr(f"{at} % {b}L"))
    for i, key in enumerate(keys):
        source, target, size = ("_l", "_r", b) if i % 2 else ("_r", "_l", a)
        df = df.withColumn("_v", (F.col(source) + F.lit(key[0])) % PRIME)
        df = df.withColumn("_v", (F.col("_v") * F.col("_v") + F.lit(key[1])) % PRIME)
        df = df.withColumn("_v", (F.col("_v") * ((F.col("_v") + F.lit(key[2])) % PRIME) + F.col(source)) % PRIME)
        df = df.withColumn(target, (F.col(target) + F.col("_v")) % size)
    reached = F.col("_l") * F.lit(b).cast("long") + F.col("_r")
    return df.withColumn(at, F.when(F.col(at) >= n, reached).otherwise(F.col(at)) if walk else reached).drop("_l", "_r", "_v")


def content_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long")


def content_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def row_hash(seed: int) -> Column:
    """60 bits of a SHA-256 of (seed, id, size, CRC), so that any SQL engine can repeat the order,
    as the high bits of a long."""
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("text_crc32").cast("string")), 256)
    return F.shiftleft(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 4)


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 20_240_229, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: id, size, text_crc32, row_number, shard, slot; one row per row of ``docs``.

    Two shuffles of narrow rows (id, size, CRC): repeats are folded into a count map-side
    first, then numbered inside hash buckets. The text itself never moves.
    """
    narrow = docs.select(F.col(id_col).alias("id"), content_size(F.col(text_col)).alias("size"), content_crc(F.col(text_col)).alias("text_crc32"))
    folded = narrow.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies")).withColumn("h", row_hash(seed))
    folded = materialise(folded, "shard-rows")
    total, groups, most = folded.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("copies"), F.lit(0))).first()
    numbered = running_offset(folded, "copies", "h", ["id", "size", "text_crc32"], bucket_count(groups), [], "first_number")
    pieces = numbered.withColumn("piece", F.explode(F.expr(f"sequence(0L, (copies - 1) div {PIECE}L)")))
    if most > PIECE:  # a row repeated very often: its pieces go to different tasks before they unfold
        pieces = pieces.repartition("first_number", "piece")
    spread = pieces.select("id", "size", "text_crc32", F.explode(F.expr(f"sequence(first_number + piece * {PIECE}L, first_number + least(copies, (piece + 1) * {PIECE}L) - 1)")).alias("row_number"))
    n, (a, b), keys = max(1, int(total)), halves(max(1, int(total))), round_keys(seed)
    placed = _permuted_column(spread.withColumn("_at", F.col("row_number")), "_at", n, a, b, keys, walk=False)
    for _ in range(longest_walk(n, seed)):
        placed = _permuted_column(placed, "_at", n, a, b, keys, walk=True)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "row_number", (F.col("_at") % shards).cast("int").alias("shard"), F.expr(f"_at div {shards}L").alias("slot"))


def digest(docs: DataFrame, shards: int = 24, seed: int = 20_240_229) -> DataFrame:
    """The contract's columns: the law is ``rows`` (counts at most one apart)."""
    return shard_rows(docs, shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")

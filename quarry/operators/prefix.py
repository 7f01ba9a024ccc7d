"""Running sums and row numbers over all rows of a table, with no task that sees them all.

Rows are dealt into about sqrt(n) buckets by the leading bits of a hash. Sums per bucket
are few, so one small window turns them into bucket offsets; the rest is a window inside
each bucket. A group of identical rows never needs one task: callers fold repeats into a
count first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialise


def bucket_count(rows: int) -> int:
    """A power of two near sqrt(rows) / 2: as many buckets as a bucket has rows, roughly."""
    return 1 << max(0, round(math.log2(max(1.0, math.sqrt(max(1, rows)) / 2))))


def bucket_of(hashed: Column, buckets: int) -> Column:
    """The leading bits of a 64-bit hash: buckets follow the order of ``unsigned(hashed)``."""
    bits = buckets.bit_length() - 1
    return F.lit(0).cast("long") if bits == 0 else F.shiftrightunsigned(hashed, 64 - bits)


def unsigned(hashed: Column) -> Column:
    """Order of the hash read as unsigned: signed order with the top bit flipped."""
    return hashed.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def running_offset(df: DataFrame, amount: str, hashed: str, order: list[str], buckets: int, keys: list[str], out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows that come before, within ``keys``.

    Order: ``hashed`` (unsigned), then the columns of ``order``. Rows equal in all of them
    must be interchangeable for the caller. With no ``keys`` the sum runs over all rows.
    """
    marked = df.withColumn("_bucket", bucket_of(F.col(hashed), buckets))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(unsigned(F.col(hashed)), *[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy(*keys, "_bucket").agg(F.sum(amount).alias("_in_bucket"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_b"), F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_start"))
    on = F.col("_bucket") == F.col("_b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return marked.withColumn("_within", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(starts, on).withColumn(out, (F.col("_start") + F.col("_within")).cast("long")).drop("_bucket", "_within", "_b", "_start", *[f"_k_{k}" for k in keys])


def running_in_order(df: DataFrame, amount: str, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over a key's rows that come before, in the order given.

    Rows are dealt by ranges of (keys, order) and written with their range's number, so a key
    with most rows spans many tasks; a key has at most one sum a range in any window. Rows
    equal in keys and order must be interchangeable for the caller.
    """
    ranged = materialise(df.repartitionByRange(*keys, *order).withColumn("_bucket", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_b")).agg(F.sum(amount).alias("_in_bucket"))
    starts = sums.withColumn("_start", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0))).drop("_in_bucket")
    on = F.col("_bucket") == F.col("_b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    within = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return ranged.withColumn("_within", within).join(starts, on).withColumn(out, F.col("_start") + F.col("_within")).drop("_bucket", "_b", "_start", "_within", *[f"_k_{k}" for k in keys])

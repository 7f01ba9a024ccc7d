"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of ``block`` words each. Slot n has the golden-ratio point
frac(n / phi); the point falls into one source's stretch of the cumulative weights, and
the slot's rank among its source's slots says which block of the source it takes. A
source's blocks cut its shuffled documents, laid end to end and repeated up to three
times, into equal runs of words. Golden-ratio points fill every stretch evenly, so each
source gets its share of slots to within a few, at every length of the mix. A source whose
target is under ``EXACT`` blocks of more than a word takes that many words exactly instead:
few slots would miss a small target by much, or leave it none.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the
total size; a target stops at three times its source's size and the excess goes to the
others by weight. That fixed point is found in closed form: with sources ordered by
cap / weight, one is capped exactly when the level left for it and those behind reaches
its cap.

Only DataFrame functions. Sums and ranks go through hash buckets (``prefix``), so a source
with a third of all rows is never one task's. Results by case: a null or blank text has
size 0 and takes nothing; a null source is a source, the last; equal rows are
interchangeable and each has its own result row; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.prefix import bucket_count, running_offset
from quarry.session import materialise

#: Word of a document, for sizes.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of sources, repeating in code-point order.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
EPOCHS = 3
#: Block length: the total over 2**20, within these bounds. Slots so number about a
#: million, or, for totals over 4e9 words, one for each 4096 words.
LEAST_BLOCK, MOST_BLOCK, SLOT_BITS = 1, 4096, 20
#: Targets under so many blocks are met to the word; the others, by slots, to a few blocks.
EXACT = 1024
#: Stretches of slots ranked together; cells of the cumulative weights.
SLOTS_A_RUN, CELLS = 4096, 4096

getcontext().prec = 60
_INVERSE_PHI = (Decimal(5).sqrt() - 1) / 2
#: The fraction by which a step of 2**16 slots moves the point, exact to a double.
_FINE, _COARSE = float(_INVERSE_PHI), float((_INVERSE_PHI * 65536) % 1)


def text_key(text: Column) -> Column:
    """What tells texts apart; a null text is not the empty one."""
    return F.sha2(F.coalesce(F.concat(F.lit("t"), text), F.lit("")), 256)


def row_key(row_id: Column, key: Column) -> Column:
    """Id and text as one key that is never null."""
    return F.concat(F.when(row_id.isNull(), F.lit("-")).otherwise(F.concat(F.lit("i"), row_id.cast("string"))), F.lit("|"), key)


def shuffled(seed: int, row_id: Column, key: Column) -> Column:
    """60 bits of a SHA-256, so that any SQL engine can repeat the shuffle, as the high bits of a long."""
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.coalesce(row_id.cast("string"), F.lit("")), key), 256)
    return F.shiftleft(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 4)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, source, size, text_key, h): what the schedule needs of each document."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        text_key(text).alias("text_key"),
    ).withColumn("h", shuffled(seed, F.col("id"), F.col("text_key")))


def source_targets(sizes: DataFrame) -> DataFrame:
    """A row for each source: source, number, weight, source_size, target, low, high.

    ``low`` and ``high`` bound its stretch of the cumulative weights. The windows run over
    one row per source, after a map-side partial sum.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    named = per_source.withColumn("number", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(weights, F.col("number") % len(WEIGHTS) + 1))
    named = named.withColumn("cap", F.col("source_size") * F.lit(float(EPOCHS))).withColumn("total", F.sum("source_size").over(everything).cast("double"))
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), "number")
    before, behind = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    levelled = named.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("sharing", F.sum("weight").over(behind))
    levelled = levelled.withColumn("capped", F.col("left") * F.col("weight") > F.col("cap") * F.col("sharing"))
    free = F.when(~F.col("capped"), F.col("weight"))
    level = (F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))) / F.sum(free).over(everything)
    targeted = levelled.withColumn("target", F.when(F.col("capped") | F.col("cap").eqNullSafe(F.lit(0.0)), F.col("cap")).otherwise(level * F.col("weight")))
    so_far = by_name.rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum("target").over(everything)
    high = F.when(F.row_number().over(everything.orderBy(F.col("number").desc())) == 1, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(F.sum("target").over(so_far), whole), F.lit(0.0)))
    bounded = targeted.withColumn("high", high)
    return bounded.withColumn("low", F.coalesce(F.lag("high").over(by_name), F.lit(0.0))).select("source", "number", "weight", "source_size", "target", "low", "high")


def block_length(total: int) -> int:
    return min(MOST_BLOCK, max(LEAST_BLOCK, total >> SLOT_BITS))


def slot_schedule(targets: DataFrame, slots: int) -> DataFrame:
    """(slot, number, rank): the source of each slot and its rank among that source's.

    Slot points meet sources through equal cells of the unit interval, an equi-join on the
    cell. Ranks are counted within runs of slots, and the runs' counts are summed up.
    """
    spark = targets.sparkSession
    fine, coarse = F.col("slot") % 65536, F.expr("slot div 65536")
    turn = fine * F.lit(_FINE) + coarse * F.lit(_COARSE)
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", turn - F.floor(turn)).withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    last = F.lit(CELLS - 1)
    stretches = targets.where("high > low").select("number", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * CELLS).cast("int"), F.least(F.floor(F.col("high") * CELLS).cast("int"), last))).alias("of_cell"))
    drawn = points.join(stretches, (F.col("cell") == F.col("of_cell")) & (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))).select("slot", "number", F.expr(f"slot div {SLOTS_A_RUN}L").alias("run"))
    counts = drawn.groupBy("number", "run").agg(F.count(F.lit(1)).alias("in_run"))
    before = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("number").alias("n"), F.col("run").alias("r"), F.coalesce(F.sum("in_run").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("number", "run").orderBy("slot")) - 1
    return drawn.withColumn("within", within).join(starts, (F.col("number") == F.col("n")) & (F.col("run") == F.col("r"))).select("slot", "number", (F.col("start") + F.col("within")).alias("rank"))


def mix(docs: DataFrame, seed: int = 20_240_301, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each document: id, text_key, source, size, source_size, target, taken.

    The text is read once for its size and never shuffled. Documents meet the slots that
    take their words by an equi-join on (source, block).
    """
    sizes = materialise(sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    targets = materialise(source_targets(sizes), "mix-targets")
    rows, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = block_length(int(total))
    placed = running_offset(sizes, "size", "h", ["id", "text_key"], bucket_count(rows), ["source"], "begin")
    facts = targets.select(F.col("source").alias("s"), "number", "source_size", "target")
    placed = placed.join(facts, F.col("source").eqNullSafe(F.col("s"))).drop("s", "h")
    placed = materialise(placed, "mix-places")
    small = F.col("target") < F.lit(float(EXACT * block)) if block > 1 else F.lit(False)
    words = placed.where((F.col("size") > 0) & ~small).select("number", "begin", "size", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch")).withColumn("from", F.col("begin") + F.col("epoch") * F.col("source_size"))
    # beyond the target and the schedule's few slots of unevenness no slot reaches
    words = words.where(F.col("from") < F.col("target") + F.lit(64.0 * block))
    parts = words.select("number", "begin", "from", (F.col("from") + F.col("size")).alias("to"), F.explode(F.expr(f"sequence(from div {block}L, (from + size - 1) div {block}L)")).alias("rank"))
    taken = (
        parts.join(slot_schedule(targets.where(~small), -(-int(total) // block)).select("number", "rank"), ["number", "rank"])
        .groupBy("number", "begin")
        .agg(F.sum(F.least("to", (F.col("rank") + 1) * block) - F.greatest("from", F.col("rank") * block)).alias("taken"))
    )
    reach = F.floor(F.col("target") + 0.5)
    turn = lambda e: F.least(F.col("size"), F.greatest(F.lit(0), reach - e * F.col("source_size") - F.col("begin")))
    exact = placed.where((F.col("size") == 0) | small).withColumn("taken", sum((turn(e) for e in range(1, EPOCHS)), turn(0)).cast("long"))
    full = placed.where((F.col("size") > 0) & ~small).join(taken, ["number", "begin"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return full.unionByName(exact).select(F.col("id").alias(id_col), "text_key", F.col("source").alias(source_col), "size", "source_size", "target", "taken")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix, whole and repeated, with the columns of ``docs``.

    A document is repeated as often as the mix takes it, to the nearest whole number; at
    most one document of a source is taken in part. Rows equal in id and text count as
    one document that is taken as often as they are together.
    """
    turns = mix(docs, id_col=id_col, text_col=text_col, **options).where("taken > 0").groupBy(row_key(F.col(id_col), F.col("text_key")).alias("_key")).agg(F.sum(F.expr("(2 * taken + size) div (2 * size)")).alias("_turns"))
    # repeats of a row fold before they meet; the join finds them dealt by the same key
    named = docs.select(row_key(F.col(id_col), text_key(F.col(text_col))).alias("own_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = named.groupBy("own_key").agg(F.first("row").alias("row"))
    mixed = once.join(turns.where("_turns > 0"), F.col("own_key") == F.col("_key"))
    return mixed.withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_turns")))).select("row.*")

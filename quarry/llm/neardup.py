"""Near-duplicates by HyperMinHash sketches, banding, estimates and exact verification.

A document's set is its distinct word shingles, as 64-bit hashes. Its sketch deals the set
into ``REGISTERS`` equal stretches of the hash range; of each stretch the smallest hash is
kept as a compressed register: the count of leading zeros of its place within the stretch
(6 bits) and the ``MANTISSA`` bits that follow. Registers are stored, 500 bytes a document.
Bands of ``ROWS`` registers are the keys under which similar sets meet; for them, empty
registers borrow from used ones.

Documents with the same set are one class (its copies are members, never pairs). Classes
that share a band meet at the band's hub: its most central class, the one whose bands are
the most populated; an original among its edited copies, as a rule. The classes around a
hub form a group, dealt into blocks of about ``BLOCK`` classes and ``BLOCK_SHINGLES``
shingles with the hub in each.

Blocks first see registers alone. A pair's Jaccard estimate is matching registers over used
ones, less the expected chance matches of compressed registers; it leaves a pair open
unless it is ``Z`` standard errors of sampling without replacement under the threshold.
Only classes with an open pair have their texts fetched. Blocks of those verify open pairs
on the full sets, unless they are in one component already: roots run along, so a group
costs about as many verifications as it has members, and a block emits one link for each
member it ties in. Groups of several blocks get a second pass, registers first again, for
the classes that did not join their hub's component: each of these meets every block. No
pair that shares a band goes uncompared.

Sets of similarity 0.8 share one of 50 bands of 5 with a probability over 1 - 1e-8.

Results by case: a text that is null or has no words has an empty set, is its own
component and is kept; a text of fewer words than a shingle has one shingle, the whole;
repeated rows are members of one class; a null id never names a component that has
another; a class whose members all lack an id has a null component; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import connected_components
from quarry.llm.words import Hashes, scrambled, shingles, spaced
from quarry.session import materialise

BANDS, ROWS = 50, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Leading zeros take 6 bits; 63 with all mantissa bits set says that a stretch is empty.
EMPTY = np.uint16(0xFFFF)
#: Classes and shingles that meet in a block, about.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: A hub's rows are spread over so many keys where they look up its number of blocks.
SALTS = 32
#: Words of the bitmap that says which texts are wanted: 2**19 rows of 16 bytes at most.
FILTER_WORDS = 1 << 19
#: Standard errors that an estimate may fall short of the threshold.
Z = 5.0

_EDGES = np.array([(i << 64) // REGISTERS for i in range(REGISTERS)], dtype=np.uint64)


class Sketcher:
    """Sets, registers and band keys of texts."""

    def __init__(self, width: int):
        self.width, self.hashes = width, Hashes(200_000)

    def set_of(self, text: bytes | None) -> np.ndarray:
        """Distinct shingles, sorted."""
        return np.unique(shingles(self.hashes.of(spaced(text or b"")), self.width))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set: its first member of each stretch, compressed."""
    at = np.searchsorted(hashes, _EDGES)
    used = np.flatnonzero(np.diff(np.append(at, len(hashes))) > 0)
    out = np.full(REGISTERS, EMPTY, dtype=np.uint16)
    place = hashes[at[used]] * np.uint64(REGISTERS)  # modulo 2**64: the place within the stretch
    zeros = np.full(len(place), 63)
    some = place > 0
    zeros[some] = np.minimum(63, 64 - np.frexp(place[some].astype(np.float64))[1])
    # rounding up to a power of two can count one zero too few
    high = (place >> np.minimum(63, 63 - zeros).astype(np.uint64)) == 0
    zeros[high & some & (zeros < 63)] += 1
    mantissa = (place << np.minimum(63, zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out[used] = np.minimum((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa, np.uint64(0xFFFE)).astype(np.uint16)
    return out


def _donors(tries: int) -> np.ndarray:
    """For each try and register, the register that an empty one borrows from."""
    at = np.arange(tries * REGISTERS, dtype=np.uint64).reshape(tries, REGISTERS)
    return (scrambled(at + np.uint64(0x51ED270B)) % np.uint64(REGISTERS)).astype(np.int64)


_FEW, _MANY = _donors(32), _donors(1024)


def filled(sketch: np.ndarray) -> np.ndarray:
    """Registers for banding: an empty one borrows, in the order all sketches share, from the
    first used one it is sent to. So a band of a short text holds ROWS draws from its set."""
    values = (np.arange(REGISTERS) << 16) | sketch
    for table in (_FEW, _MANY):
        empty = np.flatnonzero(values & 0xFFFF == int(EMPTY))
        if not len(empty):
            return values
        donors = table[:, empty]
        good = sketch[donors] != EMPTY
        values[empty] = np.where(good.any(0), values[donors[good.argmax(0), np.arange(len(empty))]], values[empty])
    used = np.flatnonzero(sketch != EMPTY)
    empty = np.flatnonzero(values & 0xFFFF == int(EMPTY))
    values[empty] = values[used[np.searchsorted(used, empty) % len(used)]]
    return values


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for each band."""
    rows = filled(sketch).reshape(BANDS, ROWS).astype(np.uint64)
    key = scrambled(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
    for i in range(ROWS):
        key = scrambled(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def sketched(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n_shingles, print, registers): a map over all rows."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(width)
        for batch in batches:
            sizes, prints, sketches = [], [], []
            for text in batch.column(2):
                own = sketcher.set_of(text.as_py())
                sizes.append(len(own))
                prints.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sketches.append(registers(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary())], names=["id", "text_key", "n_shingles", "print", "registers"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("print", T.BinaryType()), T.StructField("registers", T.BinaryType())])
    return docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(own_id, own_key, row): whole rows beside their keys, so that no column can clash."""
    return docs.select(F.col(id_col).alias("own_id"), text_key(text_col).alias("own_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull())


def jaccard_reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b|, on the full sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def estimates(one: np.ndarray, others: np.ndarray, n_one: int, n_others: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates, and which of them can't rule a link out."""
    used = (others != EMPTY) | (one != EMPTY)[None]
    k = used.sum(1)
    same = ((others == one[None]) & used).sum(1)
    chance = k * (2.0**-MANTISSA / 3)  # two unlike minima agree in zeros and mantissa
    estimate = np.clip((same - chance) / np.maximum(k - chance, 1e-9), 0, 1)
    threshold = percent / 100
    union = (n_one + n_others) / (1 + threshold)
    error = np.sqrt(threshold * (1 - threshold) / np.maximum(k, 1) * np.clip(1 - (k - 1) / union, 0, 1))
    sizes = 100 * np.minimum(n_one, n_others) >= percent * np.maximum(n_one, n_others)
    return estimate, sizes & (estimate >= threshold - Z * error - 0.01)


def open_pairs(sketches: np.ndarray, sizes: np.ndarray, is_open: np.ndarray, roots: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(member, later members it may be linked to, the likeliest first), every pair once: a
    pair has an open member, different roots (as they are when its turn comes) and an
    estimate that can't rule a link out."""
    for i in range(len(sizes)):
        later = np.arange(i + 1, len(sizes))
        later = later if is_open[i] else later[is_open[i + 1 :]]
        later = later[roots[later] != roots[i]]
        if len(later):
            estimate, possible = estimates(sketches[i], sketches[later], int(sizes[i]), sizes[later], percent)
            if possible.any():
                yield i, later[possible][np.argsort(-estimate[possible], kind="stable")]


def linked(members: list[tuple[int, int, bool, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links that tie a block together, from (id, root so far, open, set); pairs with an open
    member are compared. The first member is the hub."""
    roots = np.unique([m[1] for m in members], return_inverse=True)[1]
    sketches = np.stack([registers(m[3]) for m in members])
    out = []
    for i, others in open_pairs(sketches, np.array([len(m[3]) for m in members]), np.array([m[2] for m in members]), roots, percent):
        for j in others:
            if roots[i] != roots[j] and jaccard_reaches(members[i][3], members[j][3], percent):
                out.append((members[i][0], members[j][0]))
                roots[roots == roots[j]] = roots[i]
    return out


KEYS = ["hub", "part", "block", "cid", "root", "open", "lead"]
KEY_TYPES = "hub long, part int, block int, cid long, root long, open boolean, lead boolean"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The members of one block after another: (cid, root, open, lead, *rest), the hub first; a
    class that comes more than once is one member."""
    current, held = None, {}
    for batch in batches:
        keys = zip(*(batch.column(i).to_pylist() for i in range(len(KEYS))))
        for (hub, part, block, cid, root, is_open, lead), *rest in zip(keys, *batch.columns[len(KEYS) :]):
            if (hub, part, block) != current:
                if len(held) > 1:
                    yield [(*current, *m) for m in sorted(held.values(), key=lambda m: (not m[3], m[0]))]
                current, held = (hub, part, block), {}
            old = held.get(cid)
            held[cid] = (cid, root, is_open or (old is not None and old[2]), lead or (old is not None and old[3]), *(x.as_py() for x in rest))
    if len(held) > 1:
        yield [(*current, *m) for m in sorted(held.values(), key=lambda m: (not m[3], m[0]))]


def _dealt(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(*KEYS, *more).repartition("hub", "part", "block").sortWithinPartitions("hub", "part", "block")


def undecided(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (``KEYS``) of members with a pair that registers leave open, from rows with
    n_shingles and registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in _blocks(batches):
            roots = np.unique([m[4] for m in members], return_inverse=True)[1]
            sketches = np.stack([np.frombuffer(m[8], np.uint16) for m in members])
            stay = np.zeros(len(members), bool)
            for i, others in open_pairs(sketches, np.array([m[7] for m in members]), np.array([m[5] for m in members]), roots, percent):
                stay[i] = True
                stay[others] = True
            if stay.any():
                kept = [m[:7] for m, s in zip(members, stay) if s]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*kept), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))], names=KEYS)

    return _dealt(rows, "n_shingles", "registers").mapInArrow(run, KEY_TYPES)


def block_links(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) from rows (``KEYS``, text), a task a block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(width)
        for members in _blocks(batches):
            found = linked([(m[3], m[4], m[5], sketcher.set_of(m[7])) for m in members], percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

    return _dealt(rows, "text").mapInArrow(run, "a long, b long")


def classes_of(sketches: DataFrame) -> DataFrame:
    """(cid, print, label, rep_id, rep_key, n_shingles, registers): a row for each different set."""
    named = sketches.where("print is not null").groupBy("print").agg(
        F.min("id").alias("label"),
        F.min(F.struct(F.col("id").isNull().alias("n"), "id", "text_key")).alias("rep"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"),
    )
    return named.select(F.monotonically_increasing_id().alias("cid"), "print", "label", F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"), "n_shingles", "registers")


def band_rows(classes: DataFrame) -> DataFrame:
    """(cid, band): a row for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                bands = np.concatenate([band_keys(np.frombuffer(r.as_py(), np.uint16)) for r in part.column(1)])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), BANDS), pa.int64()), pa.array(bands, pa.int64())], names=["cid", "band"])

    return classes.select("cid", "registers").mapInArrow(run, "cid long, band long")


def hub_groups(classes: DataFrame) -> DataFrame:
    """(hub, cid): which classes meet at which hub; hubs are members of their groups.

    Band rows are shuffled once: the count and the members of a band come from the same
    exchange. Of a hot band only pairs of numbers meet in a task.
    """
    keyed = band_rows(classes).repartition("band")
    # both columns are used on both sides, else one would be pruned and the exchange made twice
    counts = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi").select("band", "n")
    shared = materialise(keyed.join(counts, "band"), "neardup-bands")
    weights = shared.groupBy("cid").agg(F.sum("n").alias("weight"))
    hubs = shared.join(weights, "cid").groupBy("band").agg(F.max(F.struct("weight", (-F.col("cid")).alias("minus"))).alias("top")).select("band", (-F.col("top.minus")).alias("hub"))
    return shared.join(hubs, "band").select("hub", "cid").distinct()


def texts_of(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, text) of the classes in ``reps`` (cid, rep_id, rep_key).

    Only texts that may be wanted are shuffled: a bitmap of ``FILTER_WORDS`` words of 64 bits,
    a fixed size that every executor can hold, has a bit for each wanted key. Once most bits
    are set it lets more pass, and the join still finds the right ones. Repeated rows fold
    before they meet.
    """
    word = lambda k: F.expr(f"pmod({k}, {FILTER_WORDS}L)")
    bit = lambda k: F.expr(f"shiftleft(1L, cast(pmod(shiftright({k}, 32), 64L) as int))")
    bitmap = reps.groupBy(word("rep_key").alias("word")).agg(F.bit_or(bit("rep_key")).alias("bits"))
    named = docs.select(F.col(id_col).alias("t_id"), text_key(text_col).alias("t_key"), F.col(text_col).cast("binary").alias("text"))
    likely = named.join(F.broadcast(bitmap), word("t_key") == F.col("word")).where(F.col("bits").bitwiseAND(bit("t_key")) != 0)
    once = likely.groupBy("t_id", "t_key").agg(F.first("text").alias("text"))
    return reps.join(once, F.col("rep_id").eqNullSafe(F.col("t_id")) & (F.col("rep_key") == F.col("t_key"))).select("cid", "text")


def _with_parts(rows: DataFrame, parts: DataFrame, name: str, other: int | None = 1) -> DataFrame:
    """Rows with their hub's number from ``parts`` (hub, ``name``), ``other`` for hubs not there; a
    hub's rows are spread over ``SALTS`` keys."""
    salted = parts.select(F.col("hub").alias("_hub"), name, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_of"))
    salt = F.pmod(F.xxhash64("cid", F.lit(7)), F.lit(SALTS).cast("long")).cast("int")
    found = rows.withColumn("_salt", salt).join(salted, (F.col("hub") == F.col("_hub")) & (F.col("_salt") == F.col("_of")), "left")
    return found.withColumn(name, F.coalesce(name, F.lit(other))).drop("_hub", "_of", "_salt")


def _hashed(parts: str, seed: int) -> Column:
    return F.pmod(F.xxhash64("cid", F.lit(seed)), F.col(parts).cast("long")).cast("int")


def components_of(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(sketch rows without registers, classes with their component's root and whether any link ties them)."""
    sketches = materialise(sketched(docs, width, id_col, text_col), "neardup-sketches")
    classes = materialise(classes_of(sketches), "neardup-classes")
    members = hub_groups(classes).join(classes.select("cid", "n_shingles"), "cid")
    members = materialise(members, "neardup-groups")
    shingles_of = F.sum("n_shingles")
    many = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(shingles_of / BLOCK_SHINGLES)).cast("int")
    large = members.groupBy("hub").agg(many.alias("blocks")).where("blocks > 1")
    blocked = _with_parts(members, large, "blocks").withColumn("home", _hashed("blocks", 0))

    def compared(rows: DataFrame, label: str) -> DataFrame:
        sketch = classes.select("cid", "n_shingles", "registers")
        likely = materialise(undecided(rows.join(sketch, "cid"), percent), f"neardup-open-{label}")
        reps = classes.select("cid", "rep_id", "rep_key").join(likely.select("cid").distinct(), "cid", "left_semi")
        return materialise(block_links(likely.join(texts_of(docs, reps, id_col, text_col), "cid"), width, percent), f"neardup-links-{label}")

    everywhere = F.when(F.col("cid") == F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("home"))
    links = compared(blocked.select("hub", F.lit(0).alias("part"), F.explode(everywhere).alias("block"), "cid", F.col("cid").alias("root"), F.lit(True).alias("open"), (F.col("cid") == F.col("hub")).alias("lead")), "1")
    roots = connected_components(links)
    wide = blocked.where("blocks > 1")
    if wide.limit(1).count():
        known = wide.join(roots, wide["cid"] == roots["id"], "left").select("hub", "blocks", "home", "cid", F.coalesce("root", "cid").alias("root"))
        hub_roots = known.where("cid = hub").select("hub", F.col("root").alias("hub_root"))
        known = materialise(_with_parts(known, hub_roots, "hub_root"), "neardup-large")
        apart = known.where("root <> hub_root")
        parts = apart.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
        visiting = _with_parts(apart, parts, "parts").select("hub", _hashed("parts", 1).alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "cid", "root", F.lit(True).alias("open"), F.lit(False).alias("lead"))
        # a hub none of whose classes is apart has no visitors, and its blocks no pairs
        staying = _with_parts(known, parts, "parts", 0).where("parts > 0").select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("home").alias("block"), "cid", "root", F.lit(False).alias("open"), F.lit(False).alias("lead"))
        roots = connected_components(links.union(compared(visiting.unionByName(staying), "2")))
    rooted = classes.drop("registers", "n_shingles").join(roots, F.col("cid") == F.col("id"), "left").withColumn("tied", F.col("id").isNotNull()).drop("id").withColumn("root", F.coalesce("root", "cid"))
    return sketches.drop("registers"), rooted


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    rows, classes = components_of(docs, width, percent, id_col, text_col)
    # only roots that other classes lead to, spread over salts: a component can have most classes
    names = classes.where("tied").groupBy(F.col("root").alias("hub")).agg(F.min("label").alias("component"))
    labelled = _with_parts(classes.withColumn("hub", F.when(F.col("tied"), F.col("root")).otherwise(-1 - F.col("cid"))), names, "component", None)
    labelled = labelled.select(F.col("print").alias("p"), F.when(F.col("tied"), F.col("component")).otherwise(F.col("label")).alias("component"))
    found = rows.join(labelled, F.col("print") == F.col("p"), "left")
    component = F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col("component"))
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def unique_rows(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, and all rows without words; all columns kept.

    The row that stays has the component's smallest id. Exact repeats of a row (id and
    text) are one document.
    """
    rows, classes = components_of(docs, width, percent, id_col, text_col)
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("rep_id").isNull().alias("n"), "rep_id", "rep_key")).alias("r")).select(F.col("r.rep_id").alias("_i"), F.col("r.rep_key").alias("_k"))
    stay = best.union(rows.where("print is null").select("id", "text_key")).distinct()
    named = packed(docs, id_col, text_col)
    kept = named.join(stay, F.col("own_id").eqNullSafe(F.col("_i")) & (F.col("own_key") == F.col("_k")), "left_semi")
    return kept.dropDuplicates(["own_id", "own_key"]).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: shingles of two words."""
    return near_duplicates(docs, width=2)

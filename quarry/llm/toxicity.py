"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

Features of a text: its distinct words, adjacent word pairs and skip-grams (pairs with up
to ``SKIP`` words between), hashed into 2**BITS places; words also count by their first
``STEMS`` bytes, so that inflected and compounded forms share what is learned.
FTRL-proximal keeps for each coordinate the sum of adjusted gradients z and of squared
gradients n: the learning rate of a coordinate falls with its own n, and an L1 threshold
on z leaves most weights at exactly zero. What is scored with is the list of non-zero
weights, a few thousand, bounded by the number of places.

Training reads a bounded sample of labelled rows (``SAMPLE``: the rows with the smallest
hash of their id, an id once). Their texts become feature numbers where they are read; one
task gets the numbers as compressed gaps, at most 2**BITS a row however long a text is, and
keeps them so. Scoring is a map over
all rows in Arrow batches, with the weights broadcast; no text ever moves.

Learning and holding out: a row is held out if crc32(id as text) mod 5 is 0; only labels
of the others are read. Label, language, source and id are never features.

Results by case: null and empty texts have no words and get the score of the intercept;
null labels are no labels; an id labelled twice counts once, as toxic if either says so,
and an id with several texts teaches the one of smallest SHA-256; without labels of both kinds every
score is the smoothed share of toxic labels, 0.1 for none; repeated rows each get their
row; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import alnum, scrambled

BITS = 20
#: Words between the two of a skip-gram, at most.
SKIP = 2
#: Labelled rows to learn from, at most (about; rows are taken by hash).
SAMPLE = 12_000
EPOCHS = 10
ALPHA, BETA, L1, L2 = 0.5, 1.0, 6.0, 0.2
#: Lengths, in bytes, of the word beginnings that are features too.
STEMS = (6, 7, 8)
_TURN = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class WordTable(dict):
    """Numbers of words, and by number the hashes of the word and of its beginnings."""

    def __init__(self, size: int = 300_000):
        super().__init__()
        self.hashes = np.empty((size, 1 + len(STEMS)), dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.hashes[n] = [xxhash.xxh3_64_intdigest(word), *(xxhash.xxh3_64_intdigest(word[:k], seed=k) for k in STEMS)]
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row of hashes for each word; the table starts anew when it could get too small."""
        if len(self) + len(words) > len(self.hashes):
            self.clear()
            if len(words) > len(self.hashes):
                self.hashes = np.empty((len(words), self.hashes.shape[1]), dtype=np.uint64)
        return self.hashes[np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))]


class Features:
    """Feature numbers of texts; keeps the hashes of common words."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.table = WordTable()

    def of(self, text: bytes | None) -> np.ndarray:
        """With repeats, in no particular order."""
        rows = self.table.of(alnum(text or b""))
        words = rows[:, 0]
        parts = [rows.ravel()]
        for gap in range(1, SKIP + 2):
            if len(words) > gap:
                parts.append(words[:-gap] * _TURN + words[gap:] + np.uint64(gap))
        return (scrambled(np.concatenate(parts)) >> self.shift).astype(np.int64)


class Ftrl:
    """Weights for binary features, learned one row at a time."""

    def __init__(self, places: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(places + 1), np.zeros(places + 1)  # the last place is the intercept
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        threshold = np.full(len(z), self.l1)
        threshold[-1] = 0.0  # callers put the intercept last
        return np.where(np.abs(z) <= threshold, 0.0, -(z - np.sign(z) * threshold) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        gradient = sigmoid(w.sum()) - label
        step = (np.sqrt(self.n[at] + gradient * gradient) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - step * w
        self.n[at] += gradient * gradient


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def gaps_packed(numbers: np.ndarray) -> bytes:
    """Sorted numbers under 2**32 as compressed gaps: about two bytes each."""
    return zlib.compress(np.diff(numbers, prepend=0).astype(np.uint32).tobytes(), 1)


def gaps_unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), np.uint32), dtype=np.int64)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """(place, label, features): the labelled, not held-out rows with the smallest hashes, in their order."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("text"))
    # at most ``sample`` ids: small enough for every executor, so the scan filters in place
    found = texts.join(F.broadcast(chosen), "_id")
    key = F.sha2(F.coalesce("text", F.lit(b"")), 256)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features(bits)
        for batch in batches:
            rows = [gaps_packed(np.unique(own.of(text.as_py()))) for text in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.binary())], names=["place", "label", "key", "features"])

    rows = found.select(F.xxhash64("_id").alias("place"), "label", key.alias("key"), "text").mapInArrow(numbered, "place long, label int, key string, features binary")
    return rows.groupBy("place").agg(F.max("label").alias("label"), F.min_by("features", "key").alias("features"))


def train(rows: DataFrame, epochs: int = EPOCHS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """(places, weights, intercept), the non-zero ones only."""

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for place, label, features in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                held.append((place, features.as_py(), label))
        n, toxic = len(held), sum(label for _, _, label in held)
        if toxic in (0, n):  # nothing to tell apart: the smoothed share of toxic rows
            prior = (toxic + 1) / (n + 10)
            yield pa.RecordBatch.from_pydict({"place": pa.array([1 << bits], pa.int64()), "weight": pa.array([math.log(prior / (1 - prior))], pa.float64())})
            return
        held.sort(key=lambda r: r[:2])
        model = Ftrl(1 << bits)
        for _ in range(epochs):
            for _, at, label in held:
                model.learn(gaps_unpacked(at), label)
        w = model.weights()
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"place": pa.array(kept, pa.int64()), "weight": pa.array(w[kept], pa.float64())})

    found = rows.repartition(1).mapInArrow(fitted, "place long, weight double").toArrow()
    if not found.num_rows:
        return np.empty(0, np.int64), np.empty(0), math.log(1 / 9)
    places, weights = found.column("place").to_numpy(), found.column("weight").to_numpy()
    own = places < 1 << bits
    return places[own], weights[own], float(weights[~own].sum())


class Scorer:
    """Scores of texts by broadcast weights."""

    def __init__(self, model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS):
        places, weights, self.intercept = model
        self.dense, self.features = np.zeros(1 << bits), Features(bits)
        self.dense[places] = weights

    def __call__(self, text: bytes | None) -> float:
        at = self.features.of(text)
        at = np.unique(at[self.dense[at] != 0])
        return sigmoid(self.intercept + float(self.dense[at].sum()))


def score_rows(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], keep: list[str], text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The columns ``keep`` of every row, and its score between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(shared.value, bits)
        for batch in batches:
            scores = [score(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], names=[*batch.schema.names[1:], "_score"])

    narrow = docs.select(F.col(text_col).cast("binary").alias("_text"), *[F.col(f"`{c}`") for c in keep])
    schema = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(0.0).alias("_score")).schema
    return narrow.mapInArrow(scored, schema)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    return train(training_rows(docs, labels))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    scored = score_rows(docs.select("doc_id", "text"), fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def clean_rows(docs: DataFrame, labels: DataFrame, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` scored under 0.5, all columns kept; a map, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(shared.value, bits)
        for batch in batches:
            yield batch.filter(pa.array([score(text.as_py()) < 0.5 for text in batch.column(at).cast(pa.binary())], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)

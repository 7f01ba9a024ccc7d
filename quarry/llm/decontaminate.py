"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is ten consecutive words of a benchmark item (an item of fewer words is one
window). Windows of one length m form a searcher: the shift table has, for a block of two
words, how far the search may jump when that block ends at the current position (m - 1
words if no window holds the block); a shift of zero leads to the bucket of windows with
that suffix, a second key (the window's first block) picks the test strings, and comparing
all words confirms. On text unlike the benchmark the search looks at one block in m - 1.

Documents are only mapped; texts are never shuffled or rewritten. Distinct windows are
numbered and travel by broadcast in blocks of about ``WINDOWS_A_BLOCK`` windows and
``BYTES_A_BLOCK`` bytes, however many items a window stands in; a worker builds a block's
tables once. A benchmark of several blocks takes a pass over the documents for each, which
gives spans and window numbers by a hash of the text; these narrow rows are then put
together. Windows become items afterwards: each distinct set of windows found is joined to
the items of its windows, and documents to the sets.

Results by case: null texts and items have no words; windows of an item with a null id are
searched and hit like others, but it is not among the items; an id that repeats counts once; a document word inside several windows is hit once;
repeated documents each get their row; empty tables give no rows, or no hits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.words import alnum
from quarry.session import materialise

WINDOW = 10
WINDOWS_A_BLOCK, BYTES_A_BLOCK = 200_000, 64 << 20


class Searcher:
    """Wu-Manber tables for windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], int]):
        self.length, self.block = length, min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[list[bytes], int]]]] = {}
        for window, number in windows.items():
            for end in range(self.block, length + 1):
                key = b" ".join(window[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.skip), length - end)
            suffix, prefix = b" ".join(window[-self.block :]), b" ".join(window[: self.block])
            self.buckets.setdefault(suffix, {}).setdefault(prefix, []).append((list(window), number))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, window) of every occurrence, in order."""
        length, skip, shift = self.length, self.skip, self.shift
        pair = self.block == 2
        at, n = length - 1, len(words)
        while at < n:
            key = words[at - 1] + b" " + words[at] if pair else words[at]
            far = shift.get(key, skip)
            if far:
                at += far
                continue
            start = at - length + 1
            prefix = words[start] + b" " + words[start + 1] if pair else words[start]
            for window, number in self.buckets[key].get(prefix, ()):
                if words[start : at + 1] == window:
                    yield start, number
            at += 1


def searchers(windows: list[tuple[bytes, int]]) -> list[Searcher]:
    by_length: dict[int, dict[tuple[bytes, ...], int]] = {}
    for joined, number in windows:
        words = tuple(joined.split(b" "))
        by_length.setdefault(len(words), {})[words] = number
    return [Searcher(length, found) for length, found in sorted(by_length.items())]


#: The last block's tables of this worker, by the block's name.
_BUILT: dict[str, list[Searcher]] = {}


def tables_of(block: tuple[str, list[tuple[bytes, int]]]) -> list[Searcher]:
    name, windows = block
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = searchers(windows)
    return _BUILT[name]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (window, item): the windows' words joined by spaces, as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[bytes, str | None], None] = {}
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = alnum(text) if text else []
                width = min(window, len(words))
                for i in range(len(words) - width + 1 if width else 0):
                    found[b" ".join(words[i : i + width]), item] = None
            yield pa.RecordBatch.from_pydict({"window": pa.array([w for w, _ in found], pa.binary()), "item": pa.array([i for _, i in found], pa.string())})

    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return items.mapInArrow(cut, "window binary, item string").distinct()


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def blocks_of(benchmark: DataFrame, text_col: str, window: int, block: int, item_col: str = "item_id") -> tuple[DataFrame, DataFrame, int]:
    """((window, item), (window, number, part), parts): the windows, and how they are dealt."""
    patterns = materialise(benchmark_windows(benchmark, item_col, text_col, window), "benchmark-windows")
    distinct = patterns.select("window").distinct()
    many, size = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("window")), F.lit(0))).first()
    parts = max(1, -(-many // block), -(-size // BYTES_A_BLOCK))
    numbered = distinct.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts)).cast("int")).withColumn("number", F.monotonically_increasing_id())
    return patterns, materialise(numbered, "benchmark-numbers"), parts


def _broadcast_block(numbered: DataFrame, part: int):
    rows = numbered.where(F.col("part") == part).select("window", "number").toArrow()
    windows = list(zip(rows.column("window").to_pylist(), rows.column("number").to_pylist()))
    return numbered.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, windows))


def _search_pass(docs: DataFrame, block) -> DataFrame:
    """(id, text_key, n_words, spans, windows) of rows (id, text_key, text), for one block."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(block.value)
        for batch in batches:
            n_words, spans, windows = [], [], []
            for text in batch.column(2):
                words = alnum(text.as_py() or b"")
                found, numbers = [], set()
                for table in tables:
                    for start, number in table.search(words):
                        found.append((start, start + table.length))
                        numbers.add(number)
                n_words.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(found)])
                windows.append(sorted(numbers))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(spans, spans_type), pa.array(windows, pa.list_(pa.int64()))], names=["id", "text_key", "n_words", "spans", "windows"])

    schema = T.StructType([docs.schema["id"], docs.schema["text_key"], T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("windows", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(searched, schema)


def _put_together(first: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of the first pass with what the other passes found in the same text."""
    more = others.groupBy("text_key").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("windows")).alias("w")).withColumnRenamed("text_key", "k")
    joined = first.join(more, F.col("text_key") == F.col("k"), "left")
    every = F.array_sort(F.concat("spans", F.coalesce("s", F.array().cast(SPANS))))
    # spans in order: one that starts in, or right after, the last one lengthens it
    union = F.aggregate(every, F.array().cast(SPANS), lambda done, s: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))).otherwise(F.array_append(done, s)))
    whole = F.when(F.col("k").isNull(), F.col("spans")).otherwise(union)
    return joined.select("id", "text_key", "n_words", whole.alias("spans"), F.array_sort(F.concat("windows", F.coalesce("w", F.array().cast("array<long>")))).alias("windows"))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = WINDOWS_A_BLOCK) -> DataFrame:
    """(id, n_words, spans, items) of every row: merged word spans and ids of items that occur."""
    patterns, numbered, parts = blocks_of(benchmark, text_col, window, block)
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.sha2(text, 256) if parts > 1 else F.lit(None).cast("string")).alias("text_key"), text.alias("text"))
    found = _search_pass(rows, _broadcast_block(numbered, 0))
    others = [_search_pass(rows, _broadcast_block(numbered, i)).where(F.size("spans") > 0).select("text_key", "spans", "windows").distinct() for i in range(1, parts)]
    for i, more in enumerate(others):
        others[i] = materialise(more, "benchmark-pass")
    if others:
        found = _put_together(found, reduce(DataFrame.union, others))
    found = materialise(found, "benchmark-found")
    sets = found.where(F.size("windows") > 0).select("windows").distinct()
    named = patterns.where("item is not null").join(numbered.select("window", "number"), "window").select("number", "item")
    whose = sets.select("windows", F.explode("windows").alias("number")).join(named, "number").groupBy("windows").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    hit = found.where(F.size("windows") > 0).join(whose, "windows", "left").select("id", "n_words", "spans", F.coalesce("items", none).alias("items"))
    return found.where(F.size("windows") == 0).select("id", "n_words", "spans", none.alias("items")).union(hit).withColumnRenamed("id", id_col)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = find_overlaps(docs, benchmark).withColumn("n_hit", hit)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block: int = WINDOWS_A_BLOCK) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, all columns kept; a map, no shuffle.

    A benchmark of several blocks takes a pass each over what the passes before left.
    """
    _, numbered, parts = blocks_of(benchmark, text_col, window, block)
    at = docs.columns.index(text_col)

    def kept_by(shared):
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = tables_of(shared.value)
            for batch in batches:
                words = (alnum(t.as_py() or b"") for t in batch.column(at).cast(pa.binary()))
                yield batch.filter(pa.array([all(next(table.search(w), None) is None for table in tables) for w in words], pa.bool_()))

        return kept

    for i in range(parts):
        docs = docs.mapInArrow(kept_by(_broadcast_block(numbered, i)), docs.schema)
        docs = docs if i == parts - 1 else materialise(docs, "benchmark-clean")
    return docs

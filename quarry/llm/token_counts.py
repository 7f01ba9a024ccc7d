"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

Texts are cut into pre-tokens. Distinct pre-tokens of a batch lie end to end in one array
of symbols, with another array naming each symbol's sequence (ragged rows). A round looks
up the merge rank of every adjacent pair, takes each sequence's lowest rank and applies
that pair wherever it stands in the sequence, in all sequences at once; sequences with no
pair left leave the array with their count of surviving symbols. Applying all places of
the lowest pair together equals merging one by one: a merge's product only takes part in
pairs of later rank. A sequence of more than ``LONG`` bytes has many rounds of few merges,
so it goes by itself: places wait by rank, and a round looks anew only at the pairs beside
its merges.

Executors get the merge table (at most vocabulary size, here under 2 MB) by broadcast and
work through Arrow batches; counts of pre-tokens are kept in a table of bounded size. No
row moves between executors.

Results by case: a null text counts as empty (0 bytes, 0 tokens); the added special
strings inside a text are one token each, as the library's default has it; texts of any
length are taken whole, long ones a stretch of pre-tokens at a time; each row is counted
by itself, so repeated rows and ids give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-token pattern of byte-level BPE vocabularies: a fixed value that must equal theirs.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens remembered by a worker; beyond that it starts anew.
MEMO = 400_000
#: Pre-tokens of one text handled together.
STRETCH = 200_000
#: Bytes from which a pre-token merges by itself.
LONG = 1024
NO_RANK = np.iinfo(np.int64).max


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, by its published rule.

    Printable bytes stand for themselves; the others, in order, for code points from 256.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Merge ranks in sorted arrays: symbols are numbers, the first 256 are the bytes."""

    def __init__(self, merges: list[tuple[bytes, bytes]], specials: list[str]):
        symbols = {bytes([b]): b for b in range(256)}
        for left, right in merges:
            symbols.setdefault(left + right, len(symbols))
        self.base = len(symbols)
        pairs = np.array([symbols[a] * self.base + symbols[b] for a, b in merges], dtype=np.int64)
        products = np.array([symbols[a + b] for a, b in merges], dtype=np.int64)
        pairs, first = np.unique(pairs, return_index=True)
        self.pairs, self.ranks = pairs, first.astype(np.int64)
        self.products = products
        self.specials = specials

    @classmethod
    def from_json(cls, path: str) -> MergeTable:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        cls.check(model)
        letters = byte_alphabet()
        raw = lambda s: bytes(letters[c] for c in s)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        return cls([(raw(a), raw(b)) for a, b in merges], [t["content"] for t in model.get("added_tokens", [])])

    @staticmethod
    def check(file: dict) -> None:
        """Refuse settings that would change counts and are not implemented here."""
        model, cut = file["model"], file.get("pre_tokenizer") or {}
        wrong = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        wrong += ["normalizer"] * bool(file.get("normalizer")) + ["model type"] * (model.get("type", "BPE") != "BPE")
        wrong += ["pre_tokenizer"] * (cut.get("type") != "ByteLevel" or cut.get("add_prefix_space", True) or not cut.get("use_regex", True))
        wrong += ["added_tokens"] * any(t.get(k) for t in file.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word"))
        if wrong:
            raise ValueError(f"settings of the vocabulary file that are not implemented: {', '.join(wrong)}")

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        if not len(self.pairs):
            return np.full(len(key), NO_RANK)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_RANK)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of each piece."""
        long = [i for i, p in enumerate(pieces) if len(p) > LONG]
        if long:
            out = np.zeros(len(pieces), np.int64)
            out[long] = [self.count_long(pieces[i]) for i in long]
            short = np.setdiff1d(np.arange(len(pieces)), long)
            out[short] = self.count([pieces[i] for i in short])
            return out
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        left_over = lengths.copy()
        symbols = np.frombuffer(b"".join(pieces), dtype=np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        while len(symbols) > 1:
            rank = np.full(len(symbols), NO_RANK)
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.rank_of(symbols[:-1], symbols[1:]), NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            going = np.repeat(lowest, sizes)
            hit = (rank == going) & (rank != NO_RANK)
            # in a run of hits (a pair of equal symbols) every other one applies, from the left
            place = np.flatnonzero(hit)
            if not len(place):
                break
            new_run = np.r_[True, np.diff(place) != 1]
            run_start = place[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
            place = place[(place - run_start) % 2 == 0]
            symbols[place] = self.products[rank[place]]
            keep = going != NO_RANK
            keep[place + 1] = False
            left_over -= np.bincount(owner[place], minlength=len(pieces))
            symbols, owner = symbols[keep], owner[keep]
        return left_over


    def count_long(self, piece: bytes) -> int:
        """Surviving symbols of one long piece: linked symbols, and places in wait by rank."""
        n = len(piece)
        symbols = np.append(np.frombuffer(piece, dtype=np.uint8).astype(np.int64), 0)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # n stands for the end, -1 for the start
        ranks = np.full(n + 1, NO_RANK)
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []
        left_over = n

        def look(at: np.ndarray) -> None:
            found = np.full(len(at), NO_RANK)
            inner = after[at] < n
            found[inner] = self.rank_of(symbols[at[inner]], symbols[after[at[inner]]])
            ranks[at] = found
            at, found = at[found != NO_RANK], found[found != NO_RANK]
            by_rank = np.argsort(found, kind="stable")
            at, found = at[by_rank], found[by_rank]
            for some in np.split(at, np.flatnonzero(np.diff(found)) + 1) if len(at) else ():
                rank = int(ranks[some[0]])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(order, rank)
                waiting[rank].append(some)

        look(np.arange(n))
        while order:
            rank = heapq.heappop(order)
            place = np.unique(np.concatenate(waiting.pop(rank)))
            place = place[ranks[place] == rank]
            if not len(place):
                continue
            # where a place follows right on another, every other one applies, from the left
            new_run = np.r_[True, place[1:] != after[place[:-1]]]
            at_run = np.arange(len(place)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            place = place[at_run % 2 == 0]
            gone = after[place]
            symbols[place] = self.products[rank]
            ranks[gone] = NO_RANK
            after[place] = after[gone]
            linked = after[gone] < n
            before[after[gone[linked]]] = place[linked]
            left_over -= len(place)
            look(np.unique(np.r_[place, before[place[before[place] >= 0]]]))
        return left_over


class Counter(dict):
    """Token counts of pre-tokens, filled a batch at a time and of bounded size."""

    def __init__(self, table: MergeTable, memo: int = MEMO):
        super().__init__()
        self.table, self.memo = table, memo
        self.pattern = regex.compile(PATTERN)
        self.special = regex.compile("|".join(regex.escape(s) for s in table.specials)) if table.specials else None

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self]
        if not new:
            return
        if len(self) + len(new) > self.memo:
            self.clear()
            new = list(pieces)
        self.update(zip(new, self.table.count([p.encode("utf-8", "surrogatepass") for p in new]).tolist()))

    def pieces(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """(special tokens before, pre-tokens) of one text, in stretches."""
        at = 0
        if self.special is not None:
            for found in self.special.finditer(text):
                yield from self._stretches(text[at : found.start()])
                yield 1, []
                at = found.end()
        yield from self._stretches(text[at:] if at else text)

    def _stretches(self, part: str) -> Iterator[tuple[int, list[str]]]:
        if len(part) < STRETCH:
            yield 0, self.pattern.findall(part)
        else:
            stream = (m.group() for m in self.pattern.finditer(part))
            while some := list(islice(stream, STRETCH)):
                yield 0, some

    def batch(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; pre-tokens of many texts merge together."""
        totals = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for special, some in self.pieces(text) if text else ():
                totals[i] += special
                held.append((i, some))
                size += len(some)
                if size >= STRETCH:
                    self._settle(held, totals)
                    held, size = [], 0
        self._settle(held, totals)
        return totals

    def _settle(self, held: list[tuple[int, list[str]]], totals: list[int]) -> None:
        self.learn(set().union(*(some for _, some in held)))
        for i, some in held:
            totals[i] += sum(map(self.__getitem__, some))


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``vocabulary`` is the .json's path on the driver."""
    spark: SparkSession = docs.sparkSession
    table = spark.sparkContext.broadcast(MergeTable.from_json(vocabulary))
    id_type = docs.schema[id_col].dataType

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)
        for batch in batches:
            n = pa.array(counter.batch(batch.column(2).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=[id_col, "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    narrow = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return narrow.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)

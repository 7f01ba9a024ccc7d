"""Metadata of GGUF model files, and the check of their control tokens."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The format's value types by number: fixed values.
SCALARS = {0: "B", 1: "b", 2: "H", 3: "h", 4: "I", 5: "i", 6: "f", 7: "?", 10: "Q", 11: "q", 12: "d"}
STRING, ARRAY, VERSION, CONTROL = 8, 9, 3, 3


class Malformed(ValueError):
    """A header that ends early or isn't of this format."""


class Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise Malformed("the header ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, code: str):
        return struct.unpack(f"<{code}", self.take(struct.calcsize(f"<{code}")))[0]

    def value(self, kind: int):
        if kind in SCALARS:
            return self.number(SCALARS[kind])
        if kind == STRING:
            return self.take(self.number("Q")).decode("utf-8", "replace")
        if kind == ARRAY:
            inner, n = self.number("I"), self.number("Q")
            if n > len(self.data):
                raise Malformed("an array is longer than the file")
            return [self.value(inner) for _ in range(n)]
        raise Malformed(f"unknown value type {kind}")


def metadata(data: bytes) -> dict[str, object]:
    c = Cursor(data)
    if c.take(4) != b"GGUF" or c.number("I") != VERSION:
        raise Malformed("not a GGUF file of version 3")
    c.number("Q")
    return {c.value(STRING): c.value(c.number("I")) for _ in range(c.number("Q"))}


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value, problem): a row per entry, values as JSON; a bad file is one row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    out += [(name, k, json.dumps(v), None) for k, v in metadata(data.as_py()).items()]
                except (Malformed, struct.error) as e:
                    out.append((name, None, None, str(e)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["path", "key", "value", "problem"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, "path string, key string, value string, problem string")


def control_token_problems(entries: DataFrame, tokens: list[str]) -> DataFrame:
    """(path, token, problem) of named tokens that are missing or not of the control type."""
    of = lambda key, kind: F.from_json(F.max(F.when(F.col("key") == key, F.col("value"))), kind)
    lists = entries.groupBy("path").agg(of("tokenizer.ggml.tokens", "array<string>").alias("names"), of("tokenizer.ggml.token_type", "array<int>").alias("types"))
    asked = lists.select("path", "names", "types", F.explode(F.array(*[F.lit(t) for t in tokens])).alias("token"))
    at = F.array_position("names", F.col("token"))
    problem = F.when(F.coalesce(at, F.lit(0)) == 0, "missing").when(F.try_element_at("types", at.cast("int")) != CONTROL, "not a control token")
    return asked.select("path", "token", problem.alias("problem")).where("problem is not null")

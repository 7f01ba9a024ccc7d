"""Chat formatting with a grammar round trip.

Rendered conversation: turns end to end, each between the markers of its role,

    user        ``[INST] text [/INST]``        assistant   ``<s>text</s>``
    system      ``<<SYS>>text<</SYS>>``        any other   ``[ROLE=name]text[/ROLE]``

The parser is deterministic: at a turn's start one opening marker must stand, the text
reaches to the next control string, which must be the role's closing marker; anything
else is an error. Rendering starts with the texts as they are, parses the result, and
compares the recovered turns to the source. Turns whose text conflicts get escaped (one
backslash after the first character of every control string, or of what looks like an
escaped one, so that unescaping is exact), and the loop goes on until the recovered turns
are identical.

One conversation is one row of the result; rows reach their task by conversation and come
sorted by turn, so a task holds one conversation at a time. Results by case: a null text
or role is empty; a null turn comes first; equal turns are ordered by role and text and
all kept; a null conversation id is an id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Opening and closing markers: the format itself.
MARKERS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE = "[ROLE=", "]", "[/ROLE]"
#: Control strings without their first character, which a backslash may follow.
_RESTS = r"(?:/?INST\]|/?s>|</?SYS>>|ROLE=|/ROLE\])"
PLAIN = re.compile(r"[<\[]" + _RESTS)
ESCAPABLE = re.compile(r"([<\[])(\\*" + _RESTS + ")")
ESCAPED = re.compile(r"([<\[])\\(\\*" + _RESTS + ")")
#: A role's name in its marker: these characters are written as numbers.
_NAME_UNSAFE = re.compile(r"[%\]\[<\\]")


class NotInGrammar(ValueError):
    """A text that the parser does not accept."""


def escape(text: str) -> str:
    return ESCAPABLE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def markers(role: str) -> tuple[str, str]:
    if role in MARKERS:
        return MARKERS[role]
    return OTHER_OPEN + _NAME_UNSAFE.sub(lambda m: f"%{ord(m[0]):02x}", role) + OTHER_MIDDLE, OTHER_CLOSE


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text, and the spans (code points) of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        opening, closing = markers(role)
        parts += [opening, text, closing]
        if role == "assistant":
            spans.append((at + len(opening), at + len(opening) + len(text)))
        at += len(opening) + len(text) + len(closing)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation, unescaped."""
    turns, at = [], 0
    while at < len(formatted):
        for role, (opening, closing) in MARKERS.items():
            if formatted.startswith(opening, at):
                start = at + len(opening)
                break
        else:
            if not formatted.startswith(OTHER_OPEN, at) or (end := formatted.find(OTHER_MIDDLE, at)) < 0:
                raise NotInGrammar(f"no opening marker at {at}")
            name = formatted[at + len(OTHER_OPEN) : end]
            role, closing, start = re.sub(r"%([0-9a-f]{2})", lambda m: chr(int(m[1], 16)), name), OTHER_CLOSE, end + len(OTHER_MIDDLE)
        # the closing marker may begin with a blank, which belongs to it and not to the text
        lead = len(closing) - len(closing.lstrip(" "))
        found = PLAIN.search(formatted, start)
        if found is None or found.start() - lead < start or not formatted.startswith(closing, found.start() - lead):
            raise NotInGrammar(f"turn at {at} isn't closed by its own marker")
        turns.append((role, unescape(formatted[start : found.start() - lead])))
        at = found.start() - lead + len(closing)
    return turns


def format_conversation(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Render, reparse, compare, escape what conflicts, until the turns come back identical."""
    escaped: set[int] = set()
    while True:
        formatted, spans = render([(role, escape(text) if i in escaped else text) for i, (role, text) in enumerate(turns)])
        try:
            back = parse(formatted)
        except NotInGrammar:
            back = None
        if back == turns:
            return formatted, spans
        conflicts = {i for i, (_, text) in enumerate(turns) if i not in escaped and ESCAPABLE.search(text)}
        if not conflicts:
            raise NotInGrammar("the turns don't survive the round trip")
        escaped |= conflicts


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from rows (conv_id, turn, role, text)."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    id_type = rows.schema["conv_id"].dataType

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        spans: list[list[dict]] = []
        held, current, turns = 0, None, None
        arrow_id = None

        def close() -> None:
            nonlocal held
            text, loss = format_conversation(turns)
            ids.append(current)
            texts.append(text)
            spans.append([{"start": a, "end": b} for a, b in loss])
            held += len(text)

        def out() -> pa.RecordBatch:
            nonlocal held
            batch = pa.RecordBatch.from_arrays([pa.array(ids, arrow_id), pa.array(texts, pa.string()), pa.array(spans, spans_type)], names=["conv_id", "formatted", "loss_spans"])
            ids.clear(), texts.clear(), spans.clear()
            held = 0
            return batch

        for batch in batches:
            arrow_id = batch.schema.types[0]
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if turns is None or conv != current:
                    if turns is not None:
                        close()
                        if held > 8_000_000:
                            yield out()
                    current, turns = conv, []
                turns.append((role, text))
        if turns is not None:
            close()
            yield out()

    ordered = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = T.StructType([T.StructField("conv_id", id_type), T.StructField("formatted", T.StringType()), T.StructField("loss_spans", SPANS)])
    return ordered.select("conv_id", "role", "text").mapInArrow(formatted, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rendered conversations say: turn counts, digests, text under the loss mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(text)
                whole = hashlib.sha256()
                for role, body in turns:
                    whole.update(f"{role}\n{body}\n".encode())
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                rows.append((len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = T.StructType([formatted.schema["conv_id"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(read, schema)


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns, with its conversation of control strings added."""
    conflict = "</s>[INST] ok [/INST]"
    rows = conversations.select("conv_id", "turn", "role", "text")
    extra = conversations.sparkSession.createDataFrame([(-7, 0, "user", conflict), (-7, 1, "assistant", conflict)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(extra)))

"""WARC archives with a two-level capture index.

Writing: each task appends its rows, one gzip member a record, to archives of its own in
the shared folder and returns where each record lies. Payloads of at least ``DEDUP_BYTES``
that are equal are stored once, as the response of the largest page id; the others are
revisits that name it. Files have unique names, so the files of a lost or repeated task
are simply never referred to, and the list of records is written out before it is used.

Index: captures are sorted by reversed-host URL key (``com,example,www)/path``) and page id
into parts; a part is a file of compressed blocks of ``BLOCK_LINES`` lines, followed by a
sparse directory with each block's first key. A lookup finds the part by its bounds, then
binary-searches the directory, then the block, and only then reads the record's byte range.

Reading back: a lookup for every capture, dealt out in key order so that a task reads
neighbouring blocks. Memory per task: one block, one directory, one record.

Results by case: a null page is an empty payload, a null URL an empty key; a null page id
is never the one referred to unless all ids of its group are null (all are responses then,
as are rows that repeat the largest id); repeated rows each have a record; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialise, shared_dir

DEDUP_BYTES = 1000
ARCHIVE_BYTES = 256_000_000
BLOCK_LINES = 1000
#: Captures of an index part, about, and parts at most: the driver holds two keys a part.
PART_CAPTURES, MOST_PARTS = 20_000, 4096
#: Records with equal key and id that one lookup reads.
RUN = 1000
LEVEL = 5
#: The tables have no capture times; records carry this one.
CAPTURED = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def plain(url: str | None) -> str:
    """A URL that fits one header line: blanks and controls percent-encoded."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def url_key(url: str | None) -> str:
    """Reversed host, then path and query; no scheme, port, user or fragment."""
    url = plain(url)
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return ")" + url
    return ",".join(reversed(host.lower().split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def record_id(page_id: int | None) -> str:
    return f"<urn:quarry:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    found = identifier.rpartition(":")[2].rstrip(">")
    return int(found) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {CAPTURED}", f"WARC-Target-URI: {plain(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


@dataclass
class Capture:
    page_id: int | None
    url: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None


def headers(raw: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in raw.decode().split("\r\n")[1:])}


def parse(member: bytes) -> Capture:
    """A record as it was written; a response's digest is computed anew and must agree."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = warc["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {warc['warc-record-id']} doesn't have its digest")
    size = int(headers(http)["content-length"]) if revisit else len(payload)
    return Capture(page_of(warc["warc-record-id"]), warc.get("warc-target-uri", ""), None if revisit else payload, size, digest, warc["warc-type"], page_of(warc["warc-refers-to"]) if revisit else None)


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Archive:
    """Appends records to files in a folder; a new file after ``ARCHIVE_BYTES``."""

    def __init__(self, folder: str):
        self.fs, self.path = opened(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.file = None

    def add(self, member: bytes) -> tuple[str, int, int]:
        if self.file is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.file = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        offset = self.at
        self.file.write(member)
        self.at += len(member)
        return self.name, offset, len(member)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, revisit, refers_to): which rows are stored as revisits.

    Digests of groups of two or more are few against pages; Spark broadcasts that side if
    its measured size allows and otherwise joins by shuffle, splitting skewed digests.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    # short payloads get keys of their own, which match no digest and don't pile up in one task
    large = F.octet_length("payload") >= DEDUP_BYTES
    keyed = own.withColumn("digest", F.when(large, F.sha1("payload")).otherwise(F.concat(F.lit("short-"), F.xxhash64("page_id", "url").cast("string"))))
    groups = keyed.where(large).groupBy(F.col("digest").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("largest")).where("n > 1").drop("n")
    joined = keyed.join(groups, F.col("digest") == F.col("d"), "left")
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("largest")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write every row; returns the captures (key, page_id, file, offset, length)."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = Archive(folder)
        for batch in batches:
            out = []
            for page_id, url, payload, revisit, refers_to in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                out.append((url_key(url).encode(), page_id, *archive.add(record(page_id, url, payload.as_py(), refers_to, revisit))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["key", "page_id", "file", "offset", "length"])
        archive.close()

    captures = rows.select("page_id", "url", "payload", "revisit", "refers_to").mapInArrow(written, "key binary, page_id long, file string, offset long, length long")
    return materialise(captures, "warc-captures")


def order_of(key: bytes, page_id: int | None) -> tuple[bytes, int, int]:
    """Sort order of captures; null ids first, as Spark sorts them."""
    return key, int(page_id is not None), page_id or 0


def index_line(key: bytes, page_id: int | None, *where: object) -> bytes:
    return b"\t".join([key, b"" if page_id is None else str(page_id).encode(), *(str(x).encode() for x in where)])


def line_order(fields: list[bytes]) -> tuple[bytes, int, int]:
    return order_of(fields[0], int(fields[1]) if fields[1] else None)


class PartWriter:
    """One index part: blocks, then the sparse directory, then where the directory lies."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file, self.at, self.directory, self.lines = fs.open_output_stream(path, compression=None), 0, [], []

    def add(self, line: bytes) -> None:
        self.lines.append(line)
        if len(self.lines) == BLOCK_LINES:
            self._flush()

    def _put(self, lines: list[bytes]) -> tuple[int, int]:
        data = zlib.compress(b"\n".join(lines), LEVEL)
        self.file.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)

    def _flush(self) -> None:
        if self.lines:
            first = self.lines[0].split(b"\t")
            offset, length = self._put(self.lines)
            self.directory.append(b"\t".join([*first[:2], str(offset).encode(), str(length).encode()]))
            self.lines = []

    def close(self) -> None:
        self._flush()
        self.file.write(struct.pack("<QQ", *self._put(self.directory)))
        self.file.close()


def build_index(captures: DataFrame, folder: str) -> list[tuple[tuple, tuple, str]]:
    """Write the parts; returns each one's (first, last, file), in order."""
    parts = min(MOST_PARTS, max(1, -(-captures.count() // PART_CAPTURES)))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = first = last = None
        for batch in batches:
            for key, page_id, *where in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    fs, path = opened(folder)
                    fs.create_dir(path, recursive=True)
                    name = f"{uuid.uuid4().hex}.idx"
                    writer, first = PartWriter(fs, f"{path}/{name}"), (key, page_id)
                writer.add(index_line(key, page_id, *where))
                last = (key, page_id)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*first, *last, name), (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.string()))], names=["k1", "p1", "k2", "p2", "file"])

    order = ["key", "page_id", "file", "offset"]
    made = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(built, "k1 binary, p1 long, k2 binary, p2 long, file string")
    found = materialise(made, "warc-parts").collect()  # a row for each part
    return sorted((order_of(bytes(r.k1), r.p1), order_of(bytes(r.k2), r.p2), r.file) for r in found)


class Index:
    """Lookups over the parts; keeps the directory and the block used last."""

    def __init__(self, parts: list[tuple[tuple, tuple, str]], index_folder: str, archive_folder: str, files: int = 32):
        self.parts, self.firsts, self.lasts = parts, [p[0] for p in parts], [p[1] for p in parts]
        self.index, self.archive = opened(index_folder), opened(archive_folder)
        self.handles: OrderedDict[tuple[str, str], object] = OrderedDict()
        self.files = files
        self.kept: dict[str, tuple] = {}

    def _read(self, where: tuple[pafs.FileSystem, str], name: str, offset: int, length: int) -> bytes:
        key = (where[1], name)
        if key not in self.handles:
            if len(self.handles) >= self.files:
                self.handles.popitem(last=False)[1].close()
            self.handles[key] = where[0].open_input_file(f"{where[1]}/{name}")
        self.handles.move_to_end(key)
        handle = self.handles[key]
        if offset < 0:
            offset += handle.size()
        return handle.read_at(length, offset)

    def _directory(self, name: str) -> tuple[list[tuple], list[tuple[int, int]]]:
        if self.kept.get("directory", ("",))[0] != name:
            offset, length = struct.unpack("<QQ", self._read(self.index, name, -16, 16))
            rows = [x.split(b"\t") for x in zlib.decompress(self._read(self.index, name, offset, length)).split(b"\n")]
            self.kept["directory"] = (name, [line_order(r) for r in rows], [(int(r[2]), int(r[3])) for r in rows])
        return self.kept["directory"][1:]

    def _block(self, name: str, offset: int, length: int) -> tuple[list[tuple], list[list[bytes]]]:
        if self.kept.get("block", ("",))[0] != (name, offset):
            rows = [x.split(b"\t") for x in zlib.decompress(self._read(self.index, name, offset, length)).split(b"\n")]
            self.kept["block"] = ((name, offset), [line_order(r) for r in rows], rows)
        return self.kept["block"][1:]

    def find(self, low: tuple, high: tuple) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of all captures from ``low`` to ``high``, both included."""
        for p in range(bisect_left(self.lasts, low), bisect_right(self.firsts, high)):
            name = self.parts[p][2]
            firsts, places = self._directory(name)
            for b in range(max(0, bisect_left(firsts, low) - 1), bisect_right(firsts, high)):
                orders, rows = self._block(name, *places[b])
                for row in rows[bisect_left(orders, low) : bisect_right(orders, high)]:
                    yield row[2].decode(), int(row[3]), int(row[4])

    def capture(self, file: str, offset: int, length: int) -> Capture:
        return parse(self._read(self.archive, file, offset, length))

    def of_url(self, url: str) -> Iterator[Capture]:
        """All captures of a URL, by page id."""
        key = url_key(url).encode()
        for where in self.find((key, 0, 0), (key, 2, 0)):
            yield self.capture(*where)


def read_back(captures: DataFrame, parts: list[tuple[tuple, tuple, str]], index_folder: str, archive_folder: str) -> DataFrame:
    """A lookup for every capture; what the archives say of it."""
    shared = captures.sparkSession.sparkContext.broadcast(parts)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, index_folder, archive_folder)
        for batch in batches:
            out = []
            for key, page_id, run in zip(*(c.to_pylist() for c in batch.columns)):
                at = order_of(key, page_id)
                for i, where in enumerate(index.find(at, at)):
                    if i // RUN == run:
                        c = index.capture(*where)
                        out.append((c.page_id, c.payload_bytes, c.payload_digest, c.record_type, c.refers_to))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    asked = captures.groupBy("key", "page_id").agg(F.count(F.lit(1)).alias("n")).select("key", "page_id", F.explode(F.expr(f"sequence(0L, (n - 1) div {RUN}L)")).alias("run"))
    spread = asked.repartitionByRange(max(1, 4 * len(parts)), "key", "page_id", "run").sortWithinPartitions("key", "page_id", "run")
    return spread.mapInArrow(looked_up, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, list[tuple[tuple, tuple, str]], str, str]:
    """Write pages and their index; (captures, parts, index folder, archive folder)."""
    base = folder or f"{shared_dir(pages.sparkSession)}/quarry/warc-{uuid.uuid4().hex}"
    captures = write_archives(with_revisits(pages), f"{base}/archives")
    return captures, build_index(captures, f"{base}/index"), f"{base}/index", f"{base}/archives"


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, read back from the archives."""
    return read_back(*archive(pages))

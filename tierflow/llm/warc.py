"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of a bounded number of records,
and at its end a seek table in a skippable frame: for every frame its size before and after
compression and a checksum.  A reader finds the table from the file's last bytes, so any
frame can be read without the ones before it, and any Zstandard tool still reads the whole.
The index maps a record's identifier to its bundle, frame and offset within the frame.

Of records with equal payloads the one with the smallest page id is written whole, the
others as ``revisit`` records that name it.  Payloads are compared by SHA-1 and length.

A task writes bundles under names of its own attempt, and hands on the index rows of a
bundle once the file is closed.  The index is a table written by Spark, so it names the
files of the attempts that counted and no others; a lost executor's files are never read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import id_order, stored
from tierflow.operators.joins import join_per_key

#: Bytes of records in a frame; a larger record has a frame to itself.
FRAME_BYTES = 256 * 1024
#: A task begins a new bundle beyond these.
BUNDLE_BYTES = 64 * 1024 * 1024
BUNDLE_RECORDS = 50_000
LEVEL = 3
#: Frames a task reads.  A frame's row is small, so their rows alone say nothing of the work.
FRAMES_A_TASK = 100
#: Fixed values of the seekable format: skippable frame, footer, footer's length, checksum flag.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FOOTER, WITH_CHECKSUMS = 9, 0x80
#: Fixed value: the profile of a revisit.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, offset long, length long"
RECORD = (
    "record_id string, page_id long, record_type string, uri string, payload_digest string, payload_bytes long, "
    "refers_to string, payload binary"
)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder all executors share, and the path in it."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


class Bundle:
    """A bundle being written."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        where, path = located(self.uri)
        where.create_dir(posixpath.dirname(path), recursive=True)
        self.out = where.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int, int]] = []
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.written = self.records = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Take a record; its frame and its offset there."""
        if self.waiting and self.waiting_bytes + len(record) > FRAME_BYTES:
            self.end_frame()
        at = len(self.frames), self.waiting_bytes
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        self.records += 1
        return at

    def end_frame(self) -> None:
        if not self.waiting:
            return
        raw = b"".join(self.waiting)
        frame = zstandard.ZstdCompressor(level=LEVEL).compress(raw)
        self.out.write(frame)
        self.frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.written += len(frame)
        self.waiting, self.waiting_bytes = [], 0

    def full(self) -> bool:
        return self.written >= BUNDLE_BYTES or self.records >= BUNDLE_RECORDS

    def close(self) -> None:
        self.end_frame()
        entries = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def seek_table(file) -> list[tuple[int, int, int, int]]:
    """(start, compressed size, size, checksum) of each frame, from the end of an open bundle."""
    end = file.size()
    n, flags, magic = struct.unpack("<IBI", file.read_at(FOOTER, end - FOOTER))
    if magic != SEEKABLE or not flags & WITH_CHECKSUMS:
        raise ValueError("no seek table at the end of the bundle")
    entries = file.read_at(12 * n, end - FOOTER - 12 * n)
    out, start = [], 0
    for packed, raw, check in struct.iter_unpack("<III", entries):
        out.append((start, packed, raw, check))
        start += packed
    return out


def frame_bytes(file, start: int, packed: int, raw: int, check: int) -> bytes:
    data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=raw)
    if len(data) != raw or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError("a frame's content is not what its seek table says")
    return data


def record_id(run: str, row: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{run}:{row}'.encode()).digest())}>"


def warc_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*headers, ("Content-Length", str(len(block)))] if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records from ``at`` on."""
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        lines = data[at : body - 4].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("no WARC record where one should begin")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        end = body + int(headers["Content-Length"])
        yield at, end + 4 - at, headers, data[body:end]
        at = end + 4


def as_uri(url: str | None) -> str | None:
    """A URL fit for a header: control characters and blanks percent-encoded; None for none."""
    return quote(url, safe="".join(chr(c) for c in range(33, 127))) if url else None


def write(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str | None = None,
) -> DataFrame:
    """Write a record per row into bundles under ``folder``; their index, a row per record.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest
    page id is the response, and the others revisit it; a null id is the largest.  Rows that
    share the id as well are told apart by their place in the staged table, so exactly one is
    the response.  A null html is an empty payload, a null or empty url gives no target
    header.  No rows give an empty index.  Other columns are not archived.
    """
    run = uuid.uuid4().hex
    stamp = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("html"))
    # Written once, so that a row's number stays the same whatever executor is lost.
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "*", F.sha1("html").alias("sha"), F.octet_length("html").alias("n")))
    groups = rows.filter(F.col("n") >= min_bytes).groupBy("sha", "n")
    first = groups.agg(F.count("*").alias("many"), F.min(F.struct(id_order("page_id").alias("id"), "row")).alias("first"))
    first = first.filter("many > 1").select("sha", "n", F.col("first.row").alias("first"))
    told = join_per_key(rows, first, ["sha", "n"], "left", measure=True)
    whole = F.coalesce(F.col("first") == F.col("row"), F.lit(True))
    told = told.select("row", "page_id", "url", "sha", F.when(whole, F.col("html")).alias("html"), "first")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            for (row, page, target, sha), text, first_row in zip(zip(*columns), batch.column(4), batch.column(5).to_pylist()):
                if bundle is None:
                    bundle = Bundle(folder)
                    about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", stamp)]
                    bundle.add(warc_record([*about, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    bundle.end_frame()
                name = record_id(run, row)
                body = text.as_py()
                kind = "revisit" if body is None else "response"
                data = (body or "").encode()
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                block = http + (b"\r\n" if body is None else b"Content-Length: %d\r\n\r\n" % len(data) + data)
                record = warc_record(
                    [
                        ("WARC-Type", kind),
                        ("WARC-Record-ID", name),
                        ("WARC-Date", stamp),
                        ("WARC-Target-URI", as_uri(target)),
                        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha)).decode()),
                        ("WARC-Profile", REVISIT if body is None else None),
                        ("WARC-Refers-To", record_id(run, first_row) if body is None else None),
                        ("X-Page-Id", None if page is None else str(page)),
                        ("Content-Type", "application/http; msgtype=response"),
                    ],
                    block,
                )
                frame, offset = bundle.add(record)
                index.append((name, page, kind, bundle.uri, frame, offset, len(record)))
                if bundle.full():
                    bundle.close()
                    yield table_of(index, INDEX)
                    bundle, index = None, []
        if bundle is not None:
            bundle.close()
            yield table_of(index, INDEX)

    return stored(told.mapInArrow(records, INDEX))


def table_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.record_batch([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], [name for name, _ in fields])


def content(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    """A row of ``RECORD``; a response's digest and length are those of the payload read."""
    page, kind = headers.get("X-Page-Id"), headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    data = None
    if kind == "response":
        data = block[block.index(b"\r\n\r\n") + 4 :]
        read = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if read != digest:
            raise ValueError(f"record {headers['WARC-Record-ID']}: payload digest {read}, not {digest}")
    size = None if data is None else len(data)
    page = None if page is None else int(page)
    refers = headers.get("WARC-Refers-To")
    return headers["WARC-Record-ID"], page, kind, headers.get("WARC-Target-URI"), digest, size, refers, data if payloads else None


class Opened:
    """The bundle last asked for, and its seek table."""

    def __init__(self):
        self.uri = None

    def at(self, uri: str):
        if uri != self.uri:
            where, path = located(uri)
            self.file = where.open_input_file(path)
            self.uri, self.table = uri, seek_table(self.file)
        return self

    def frame(self, number: int) -> bytes:
        return frame_bytes(self.file, *self.table[number])


def batched(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of rows and payload bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) if isinstance(row[-1], bytes) else 0
        if len(held) >= 10_000 or size >= 8_000_000:
            yield table_of(held, schema)
            held, size = [], 0
    if held:
        yield table_of(held, schema)


def read(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``bundles`` (bundle), read through their seek tables alone.

    Frames are read side by side, each by itself.  ``payload`` is null for revisits, and for
    all records without ``payloads``; ``payload_bytes`` is null for revisits (see ``resolved``).
    """

    def frames(batches):
        opened = Opened()
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                n = len(opened.at(uri).table)
                yield pa.record_batch([pa.array([uri] * n), pa.array(range(n), pa.int32())], ["bundle", "frame"])

    def records(batches):
        opened = Opened()

        def rows():
            for batch in batches:
                for uri, number in zip(*(c.to_pylist() for c in batch.columns)):
                    for _, _, headers, block in parsed(opened.at(uri).frame(number)):
                        if headers["WARC-Type"] != "warcinfo":
                            yield content(headers, block, payloads)

        return batched(rows(), RECORD)

    every = stored(bundles.select("bundle").distinct().mapInArrow(frames, "bundle string, frame int"))
    return every.repartition(tasks(every), "bundle", "frame").mapInArrow(records, RECORD)


def tasks(frames: DataFrame) -> int:
    return 1 + frames.count() // FRAMES_A_TASK


def fetch(index: DataFrame, wanted: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``index`` whose ``record_id`` is in ``wanted``; each frame they are in is read once."""
    found = stored(index.join(wanted.select("record_id").distinct(), "record_id", "left_semi").select("bundle", "frame", "offset"))
    n = tasks(found.select("bundle", "frame").distinct())
    found = found.repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")

    def records(batches):
        opened, at, data = Opened(), None, b""

        def rows():
            nonlocal at, data
            for batch in batches:
                for uri, number, offset in zip(*(c.to_pylist() for c in batch.columns)):
                    if (uri, number) != at:
                        at, data = (uri, number), opened.at(uri).frame(number)
                    _, _, headers, block = next(parsed(data, offset))
                    yield content(headers, block, payloads)

        return batched(rows(), RECORD)

    return found.mapInArrow(records, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, uri, record_id), a row per record.

    A revisit's length is its response's, ``refers_to`` the response's page id.  A revisit
    whose response is not among the records keeps nulls there.
    """
    records = stored(records.drop("payload"))
    extra = ["uri", "record_id"]
    whole = records.filter("record_type = 'response'")
    targets = whole.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"), F.col("payload_bytes").alias("size"))
    again = records.filter("record_type = 'revisit'").join(targets, "refers_to", "left")
    kept = ["payload_digest", "record_type"]
    return whole.select("page_id", "payload_bytes", *kept, F.lit(None).cast("long").alias("refers_to"), *extra).unionByName(
        again.select("page_id", F.col("size").alias("payload_bytes"), *kept, F.col("target").alias("refers_to"), *extra)
    )

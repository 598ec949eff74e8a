"""WARC archives as seekable Zstandard bundles.

An archive is a row of independent Zstandard frames, each holding whole records, and ends with a seek table in a skippable frame (the public
seekable format: compressed and decompressed size of every frame, number of frames, flags, magic number). The index maps a record to its archive,
frame, and place inside the decompressed frame, so reading a record takes the table, one range of the file and one frame.

Rows are dealt to archives by hash, so archives are alike whatever the input holds. A task writes an archive under a name of its own attempt and
then moves it to its final name; a repeated attempt writes the same bytes. Archives go through ``pyarrow.fs``, which reaches the local and the
usual remote stores.

Of records with equal payloads of at least ``REVISIT_BYTES``, that with the smallest page_id is a ``response``, the others are ``revisit`` records
without a payload, which name it and keep its length and digest.

Cases: null html is an empty payload; a null url is written as an empty one, control characters and blanks in urls are percent-encoded; rows of the
smallest page_id that repeat with the same payload are responses each; rows with a null page_id revisit those that have one, and are responses if
none has; very long records are a frame of their own; an empty table writes no archive and returns no row; other columns are not kept.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import new_folder, stage

REVISIT_BYTES = 100
FRAME_BYTES = 1 << 20
ARCHIVE_BYTES = 32 << 20
#: Bytes of records that a task reads back, and the most tasks of a job (beyond, tasks take more).
READ_BYTES, MOST_TASKS = 16 << 20, 20_000
#: Fixed values of the format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.UUID("8a5e1d62-6f0f-4c53-9d3b-0b6a4f2f7c11")
INDEX = "page_id long, record_id string, archive string, frame int, place long, size long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A response, or a revisit of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe='%:/?#[]@!$&()*+,;=~' + chr(39))}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"] if revisit else []),
        *([f"X-Page: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers of a record in lower case, and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) < length:
        raise ValueError("the record is cut off")
    return headers, rest[:length]


def result(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """What a record says of its page: id, full payload's size and digest, type, page it refers to."""
    headers, block = parse(data)
    http, _, body = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    page = int(headers["x-page"]) if "x-page" in headers else None
    stated = headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "revisit":
        return page, size, stated, "revisit", int(headers["x-refers-to-page"])
    digest = hashlib.sha256(body).hexdigest()
    if digest != stated or len(body) != size:
        raise ValueError(f"the payload of page {page} is damaged")
    return page, size, digest, "response", None


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


class Writer:
    def __init__(self, folder: str, name: str):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.final = f"{root}/{name}"
        self.working = f"{root}/_{name}-{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.working)
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.frame: list[bytes] = []
        self.filled = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """The record's frame, and its place and size in there."""
        if self.filled and self.filled + len(data) > FRAME_BYTES:
            self.flush()
        at = len(self.sizes), self.filled, len(data)
        self.frame.append(data)
        self.filled += len(data)
        return at

    def flush(self) -> None:
        if self.frame:
            packed = self.zstd.compress(b"".join(self.frame))
            self.out.write(packed)
            self.sizes.append((len(packed), self.filled))
            self.frame, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.files.move(self.working, self.final)


class Reader:
    def __init__(self, folder: str, name: str):
        files, root = fs.FileSystem.from_uri(folder)
        self.source = files.open_input_file(f"{root}/{name}")
        size = self.source.size()
        count, flags, magic = struct.unpack("<IBI", self.source.read_at(9, size - 9))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{name} has no seek table")
        table = self.source.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for packed, full in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, full))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, full = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.source.read_at(packed, at), max_output_size=full)


@lru_cache(4)
def reader(folder: str, name: str) -> Reader:
    return Reader(folder, name)


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html (binary), digest and the page to refer to."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("html")).withColumn("digest", F.sha2("html", 256))
    long = F.octet_length("html") >= REVISIT_BYTES
    first = rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored, so that Spark knows its size: where it is small the payloads need not be shuffled to meet it.
    first = stage(first, "warc-first")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Write the archives into a shared folder; the folder and the index (a staged table)."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    total = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    archives = total // archive_bytes + 1
    rows = marked(pages).withColumn("archive", F.pmod(F.xxhash64("page_id", "digest"), F.lit(archives)).cast("int"))
    # A task an archive: neither merged by the size of anything, nor two of them by chance in one task.
    dealt = rows.repartitionById(min(archives, MOST_TASKS), F.col("archive")).sortWithinPartitions("archive", "page_id", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, writer = None, None
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                page_id, url, html, digest, refers_to, archive = (c[i].as_py() for c in batch.columns)
                if archive != current:
                    if writer:
                        writer.close()
                    current, name = archive, f"pages-{archive:06d}.warc.zst"
                    writer = Writer(folder, name)
                found.append((page_id, record_id(page_id, digest), name, *writer.add(record(page_id, url, html, digest, refers_to))))
            columns = list(zip(*found, strict=True)) or [()] * 6
            types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page_id", "record_id", "archive", "frame", "place", "size"])
        if writer:
            writer.close()

    return folder, stage(dealt.mapInArrow(run, INDEX), "warc-index")


def read(folder: str, index: DataFrame) -> DataFrame:
    """What the archives say of the records of an index, or of a part of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, frame = None, b""
        for batch in batches:
            found = []
            for name, number, place, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != (name, number):
                    at, frame = (name, number), reader(folder, name).frame(number)
                found.append(result(frame[place : place + size]))
            columns = list(zip(*found, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    # By the bytes that rows of the index stand for: these are few themselves.
    tasks = (index.agg(F.sum("size")).first()[0] or 0) // READ_BYTES + 1
    dealt = index.select("archive", "frame", "place", "size").repartition(min(tasks, MOST_TASKS), "archive", "frame").sortWithinPartitions("archive", "frame", "place")
    return dealt.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")

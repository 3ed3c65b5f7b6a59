r"""WARC records in seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each with some WARC/1.1 records, and a seek
table in a skippable frame at its end (the layout of the seekable format: compressed and raw size of
each frame, then the number of frames and a magic number). The index maps a record's id to bundle,
frame and offset in the raw frame, so one record costs one ranged read and one small frame.

Writing: pages are grouped by the SHA-256 of their payload; the smallest page_id of a group is the
response, the others are revisits that name it and carry no payload (payloads under
``least_revisit`` bytes are always responses). Each task writes bundles of its own, named by task
attempt, and gives their index rows; the index is a parquet table written by Spark, so it names the
bundles of the attempts that were committed, and what a lost executor left half-done is in no index.
Bundles go through ``pyarrow.fs`` to the shared folder. A task holds one frame at a time.

Reading back: seek tables of the bundles named in the index give the frames, which are dealt out
again and read by range; payload digests are computed anew and a record that doesn't match fails.

A null html is an empty payload. A null page_id comes after all others; its record has a random id in its
headers and can only be read with the rest. WARC-Date is the time of writing; white space and control
characters of a url are percent-encoded. Rows that repeat both id and payload are all responses if
their id is the group's smallest. An empty table gives an empty index. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import time
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, landed, scratch, table

FRAME_BYTES = 1 << 20     # raw bytes after which a frame is closed
BUNDLE_BYTES = 256 << 20  # compressed bytes after which a bundle is closed
READ_BYTES = 64 << 20     # raw bytes that a task reads back, about
LEVEL = 3
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # magic numbers of the seekable format
INDEX = "page_id long, bundle string, frame int, at long, length long"
FRAMES = "bundle string, frame int, start long, packed long, raw long"
RECORDS = ("page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "url string, payload binary")


def store(uri: str):
    """(file system, path) of a folder or file of the shared store."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(value: str) -> str:
    """White space and control characters percent-encoded, so that a header stays one line."""
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: quote(m[0]), value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    own = f"urn:page:{page_id}" if page_id is not None else uuid.uuid4().urn
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{own}>", f"WARC-Date: {date}",
            "Content-Type: text/html; charset=utf-8"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    head += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"X-Payload-Length: {len(payload)}",
             f"Content-Length: {0 if revisit else len(payload)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (names lowered), content, and where the next record starts."""
    end = raw.index(b"\r\n\r\n", at)
    version, *lines = raw[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not at the start of a record")
    head = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
    body = end + 4
    stop = body + int(head["content-length"])
    return head, raw[body:stop], stop + 4


def _id(value: str | None) -> int | None:
    return int(value[len("<urn:page:"):-1]) if value and value.startswith("<urn:page:") else None


def checked(head: dict[str, str], content: bytes) -> tuple:
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and (sha1_base32(content) != digest or len(content) != int(head["x-payload-length"])):
        raise ValueError(f"the payload of {head.get('warc-record-id')} has changed")
    return (_id(head.get("warc-record-id")), head["warc-type"], _id(head.get("warc-refers-to")),
            int(head["x-payload-length"]), digest, head.get("warc-target-uri"),
            content if head["warc-type"] == "response" else None)


class Bundle:
    """Writes one bundle; a frame is packed when it has ``FRAME_BYTES``."""

    def __init__(self, folder: str):
        import zstandard

        fs, path = store(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)  # not by the name's ending
        self.pack = zstandard.ZstdCompressor(LEVEL)
        self.parts: list[bytes] = []
        self.raw = self.packed = 0
        self.sizes: list[tuple[int, int]] = []

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in it)"""
        if self.raw >= FRAME_BYTES:
            self._close_frame()
        at = len(self.sizes), self.raw
        self.parts.append(data)
        self.raw += len(data)
        return at

    def _close_frame(self) -> None:
        if self.parts:
            frame = self.pack.compress(b"".join(self.parts))
            self.out.write(frame)
            self.sizes.append((len(frame), self.raw))
            self.packed += len(frame)
            self.parts, self.raw = [], 0

    def close(self) -> None:
        self._close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(folder: str, name: str) -> list[tuple[int, int, int]]:
    """(start, packed size, raw size) of each frame, from the end of the bundle."""
    fs, path = store(folder)
    with fs.open_input_file(f"{path}/{name}") as f:
        size = f.size()
        frames, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{name} has no seek table")
        sizes = list(struct.iter_unpack("<II", f.read_at(8 * frames, size - 9 - 8 * frames)))
    out, start = [], 0
    for packed, raw in sizes:
        out.append((start, packed, raw))
        start += packed
    return out


def frame_bytes(folder: str, name: str, start: int, packed: int, raw: int) -> bytes:
    import zstandard

    fs, path = store(folder)
    with fs.open_input_file(f"{path}/{name}") as f:
        return zstandard.ZstdDecompressor().decompress(f.read_at(packed, start), max_output_size=raw)


def with_originals(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to (null for responses)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    first = rows.where(F.octet_length("payload") >= least_revisit).groupBy("digest") \
        .agg(F.min("page_id").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
        .alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, least_revisit: int = 0) -> DataFrame:
    """Writes the archives to ``folder`` and returns the index."""
    bounded_batches(pages.sparkSession)
    data = f"{folder}/bundles"
    date = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                    if bundle is None:
                        fs, path = store(data)
                        fs.create_dir(path, recursive=True)
                        bundle = Bundle(data)
                    page_id = page_id.as_py()
                    content = record(page_id, url.as_py(), payload.as_py(), refers_to.as_py(), date)
                    rows.append((page_id, bundle.name, *bundle.add(content), len(content)))
                    if bundle.packed >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
                names = ("page_id", "bundle", "frame", "at", "length")
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
        finally:
            if bundle is not None:
                bundle.close()
    return landed(with_originals(pages, least_revisit).mapInArrow(write, INDEX), f"{folder}/index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that the index names."""
    data = f"{folder}/bundles"

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(b, i, *f) for b in batch.column("bundle").to_pylist() for i, f in enumerate(seek_table(data, b))]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             ["bundle", "frame", "start", "packed", "raw"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw, at, rows = frame_bytes(data, row["bundle"], row["start"], row["packed"], row["raw"]), 0, []
                while at < len(raw):
                    head, content, at = parse(raw, at)
                    rows.append(checked(head, content))
                yield _records(rows)
    # an explicit number of partitions, as rows that name frames are few bytes and would be joined into one
    parts = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // READ_BYTES))
    frames = index.select("bundle").distinct().repartition(parts, "bundle").mapInArrow(tables, FRAMES)
    return frames.repartition(parts, "bundle", "frame").mapInArrow(records, RECORDS)


def fetch(index: DataFrame, folder: str, ids: DataFrame) -> DataFrame:
    """The records of the ids in column page_id, by index, seek table and one frame each."""
    data = f"{folder}/bundles"

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = frame_bytes(data, row["bundle"], *seek_table(data, row["bundle"])[row["frame"]])
                yield _records([checked(*parse(raw, row["at"])[:2])])
    return index.join(ids.select("page_id").distinct(), "page_id").mapInArrow(records, RECORDS)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    index = write_bundles(table(spark, sf_dir, "pages"), folder)
    return read_bundles(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
s AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY payload) AS first,
             unhex(sha1(payload))::BIT::VARCHAR AS bits FROM p)
SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (substr(bits, i * 5 + 1, 1)::INT * 16 + substr(bits, i * 5 + 2, 1)::INT * 8
         + substr(bits, i * 5 + 3, 1)::INT * 4 + substr(bits, i * 5 + 4, 1)::INT * 2 + substr(bits, i * 5 + 5, 1)::INT) + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM s
"""

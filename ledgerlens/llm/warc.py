"""WARC archives as seekable Zstandard bundles.

A page is a WARC record: ``response`` with its payload, or ``revisit`` without,
naming the response with the equal payload that has the smallest id. Equal
payloads are found by SHA-1 with a map-side minimum; a frequent payload splits
in the join. Records are grouped into independent Zstandard frames of about
``frame_bytes``, frames into bundles of about ``bundle_bytes``; a bundle ends
with a seek table (the seekable format's skippable frame), so any reader finds
a frame without reading the others. The index maps a record to its bundle,
frame and offset within the frame.

Tasks write bundles under names of their own straight into the shared folder
and return index rows; only the rows of a task's successful attempt reach the
index, so files of lost attempts are never read.

Null payloads are empty ones. Payloads shorter than ``min_bytes`` are always
responses. Rows that share the smallest id of a payload are all responses. A
null id is written as ``null`` and read back as null; among equal payloads it
counts as larger than any id, and refers_to is null if there is no other.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._spark import written
from ledgerlens.session import scratch_path

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the format


def with_types(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """(id, url, html, sha1, response: the id it refers to, revisit)"""
    p = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"),
                     F.coalesce(F.col(html), F.lit("")).cast("binary").alias("html"))
    p = p.withColumn("sha1", F.sha1("html"))
    first = (p.filter(F.length("html") >= min_bytes).groupBy(F.col("sha1").alias("s"))
             .agg(F.min("id").alias("response"), F.count("*").alias("n")).filter("n > 1").select("s", "response"))
    p = p.join(first, (F.col("sha1") == F.col("s")) & (F.length("html") >= min_bytes), "left")
    return p.select("id", "url", "html", "sha1", "response",
                    (F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))).alias("revisit"))


def record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    """One WARC record; refers_to: of a revisit, else None."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "null" if page_id is None else page_id
    uri = "".join((url or "").split())  # a header line has no breaks
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {uri}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0):
    """The record at an offset: (headers, payload, declared payload length, offset after it)."""
    split = data.index(b"\r\n\r\n", at)
    head = dict(x.split(": ", 1) for x in data[at:split].decode().split("\r\n")[1:])
    block = data[split + 4:split + 4 + int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    return head, payload, declared, split + 4 + len(block) + 4


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Bundle:
    """Writes frames and the seek table of one bundle."""

    def __init__(self, uri: str, level: int):
        import zstandard

        self.fs, self.path = _open(uri)
        self.uri, self.out = uri, self.fs.open_output_stream(self.path, compression=None)
        self.zip, self.sizes, self.size = zstandard.ZstdCompressor(level=level), [], 0

    def frame(self, data: bytes) -> None:
        packed = self.zip.compress(data)
        self.out.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.size += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(f) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame of an open bundle."""
    end = f.size()
    f.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    f.seek(end - 9 - 8 * n)
    sizes = [x for x, _ in struct.iter_unpack("<II", f.read(8 * n))]
    starts = [0]
    for s in sizes:
        starts.append(starts[-1] + s)
    return list(zip(starts, sizes))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, frame_bytes: int = 256 << 10, bundle_bytes: int = 32 << 20,
                   level: int = 3) -> DataFrame:
    """Writes bundles into ``folder`` and returns the index: (id, bundle, frame, offset, length)."""
    fs_, path = _open(folder)
    fs_.create_dir(path, recursive=True)
    schema = T.StructType([T.StructField("id", pages.schema[page_id].dataType), T.StructField("bundle", T.StringType()),
                           T.StructField("frame", T.IntegerType()), T.StructField("offset", T.LongType()),
                           T.StructField("length", T.LongType())])

    def run(batches):
        out, buf = None, io.BytesIO()
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            rows, ids = [], cols["id"]
            for i in range(batch.num_rows):
                out = out or Bundle(f"{folder}/{uuid.uuid4().hex}.warc.zst", level)
                revisit = cols["revisit"][i].as_py()
                one = record(ids[i].as_py(), cols["url"][i].as_py(), cols["html"][i].as_py(), cols["sha1"][i].as_py(),
                             cols["response"][i].as_py() if revisit else None)
                rows.append((out.uri, len(out.sizes), buf.tell(), len(one)))
                buf.write(one)
                if buf.tell() >= frame_bytes:
                    out.frame(buf.getvalue())
                    buf = io.BytesIO()
                    if out.size >= bundle_bytes:
                        out.close()
                        out = None
            if rows:
                b, f, o, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(b, pa.string()), pa.array(f, pa.int32()),
                                                  pa.array(o, pa.int64()), pa.array(n, pa.int64())], names=schema.names)
        if out:
            if buf.tell():
                out.frame(buf.getvalue())
            out.close()

    return written(with_types(pages, page_id, url, html, min_bytes).mapInArrow(run, schema), "warc-index")


_READ = "id string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def _rows(found, payloads: bool):
    """Record batch of parsed records; a response's payload must have the digest its header names."""
    cols: list[list] = [[] for _ in range(6)]
    name = lambda x: None if x == "<urn:page:null>" else x[len("<urn:page:"):-1]
    for head, payload, declared, _ in found:
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = head["WARC-Type"]
        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
        refers = head.get("WARC-Refers-To")
        for c, v in zip(cols, (name(head["WARC-Record-ID"]), declared, digest, kind, refers and name(refers),
                               payload if payloads and kind == "response" else None)):
            c.append(v)
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the index's bundles, frame by frame."""
    # a task reads whole bundles; the names alone are too small to tell a planner how many tasks that takes
    bundles = index.select("bundle").distinct().repartitionByRange(_tasks(index), "bundle")

    def run(batches):
        import zstandard

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs_, path = _open(uri)
                with fs_.open_input_file(path) as f:
                    for start, size in seek_table(f):
                        f.seek(start)
                        data, at, found = zstandard.ZstdDecompressor().decompress(f.read(size)), 0, []
                        while at < len(data):
                            found.append(parse(data, at))
                            at = found[-1][3]
                        yield _rows(found, payloads)

    return bundles.mapInArrow(run, _READ)


def fetch(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of these index rows alone: each frame they are in is sought
    by the seek table and read once; the offset within it finds the record."""
    at = index.select("bundle", "frame", "offset").repartition(_tasks(index), "bundle", "frame").sortWithinPartitions("bundle", "frame")

    def run(batches):
        import zstandard

        held, data, table, f = None, b"", [], None
        for batch in batches:
            found = []
            for uri, frame, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held[0] != uri:
                    fs_, path = _open(uri)
                    f = fs_.open_input_file(path)
                    table = seek_table(f)
                if held != (uri, frame):
                    start, size = table[frame]
                    f.seek(start)
                    data = zstandard.ZstdDecompressor().decompress(f.read(size))
                    held = (uri, frame)
                found.append(parse(data, offset))
            if found:
                yield _rows(found, payloads)

    return at.mapInArrow(run, _READ)


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                       min_bytes: int = 0) -> DataFrame:
    """Writes the archives below the shared folder and reads every record back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    folder = scratch_path(pages.sparkSession, "warc")
    kind = pages.schema[page_id].dataType
    got = read_archives(write_archives(pages, folder, page_id, url, html, min_bytes))
    return got.select(F.col("id").cast(kind).alias(page_id), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))

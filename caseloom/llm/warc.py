"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that can be read on their own; a bundle ends with a
seek table of its frames, in a skippable frame, so plain decompression reads the whole
archive too. An index maps each record to its bundle, frame and offset in the frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.scaling import Staging

# Fixed values of the seekable format: skippable frame, seek table, entries with checksum.
_SKIPPABLE, _SEEKABLE, _WITH_CHECKSUM = 0x184D2A5E, 0x8F92EAB1, 0x80

INDEX = T.StructType(
    [
        T.StructField("bundle", T.StringType()),
        T.StructField("frame", T.IntegerType()),
        T.StructField("frame_offset", T.LongType()),
        T.StructField("frame_bytes", T.LongType()),
        T.StructField("record_offset", T.LongType()),
        T.StructField("record_bytes", T.LongType()),
        T.StructField("record_id", T.StringType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("intact", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Bundling:
    """A frame is closed at ``frame_bytes`` of records, a bundle at ``bundle_bytes`` compressed;
    a larger record has a frame of its own."""

    frame_bytes: int = 1 << 20
    bundle_bytes: int = 1 << 28
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, number: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{number}')}>"


def _header_value(text: str) -> str:
    return " ".join(text.split())


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[str, bytes]:
    """``(id, bytes)`` of a response, or of a revisit if it refers to another page.

    A revisit holds the response's HTTP header, with the payload's length, and no payload.
    """
    sha = digest(payload)
    id = record_id(page_id, sha)
    revisit = refers_to is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {id}",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        fields.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        fields.append(f"WARC-Page-ID: {page_id}")
    fields.append(f"WARC-Payload-Digest: sha1:{sha}")
    fields.append(f"WARC-Block-Digest: sha1:{digest(block)}")
    if revisit:
        fields += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, sha)}",
            f"WARC-Refers-To-Page-ID: {refers_to}",
            "WARC-Truncated: length",
        ]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return id, "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """``(fields, block, end)`` of the record at ``start``."""
    stop = data.index(b"\r\n\r\n", start)
    lines = data[start:stop].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    begin = stop + 4
    end = begin + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record is cut off")
    return fields, data[begin:end], end + 4


# ---------------------------------------------------------------------------
# Bundles
# ---------------------------------------------------------------------------
class BundleWriter:
    """Frames to a stream that is only appended to, with the seek table at its end."""

    def __init__(self, stream, level: int) -> None:
        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.size = 0

    def frame(self, records: bytes) -> tuple[int, int, int]:
        """``(number, offset, compressed bytes)`` of a new frame."""
        packed = self.compressor.compress(records)
        self.stream.write(packed)
        where = (len(self.frames), self.size, len(packed))
        self.frames.append((len(packed), len(records), xxhash.xxh64_intdigest(records) & 0xFFFFFFFF))
        self.size += len(packed)
        return where

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), _WITH_CHECKSUM, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SKIPPABLE, len(body) + len(foot)) + body + foot)
        self.stream.close()


def seek_table(file) -> list[tuple[int, int, int, int]]:
    """``(offset, compressed, plain, checksum)`` of each frame, from the end of a bundle."""
    size = file.size()
    file.seek(size - 9)
    frames, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE:
        raise ValueError("not a seekable bundle")
    width = 12 if flags & _WITH_CHECKSUM else 8
    file.seek(size - 9 - frames * width)
    body = file.read(frames * width)
    table, offset = [], 0
    for k in range(frames):
        entry = struct.unpack_from("<III" if width == 12 else "<II", body, k * width)
        table.append((offset, entry[0], entry[1], entry[2] if width == 12 else -1))
        offset += entry[0]
    return table


def read_frame(file, entry: tuple[int, int, int, int]) -> bytes:
    offset, packed, plain, checksum = entry
    file.seek(offset)
    data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
    if len(data) != plain or (checksum >= 0 and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum):
        raise ValueError("a frame is damaged")
    return data


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme Spark gives it, so that tasks mean the same place.

    Without one it is a folder of the session's default file system, not of each
    executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    # a local path has no host, which a URI shows by three slashes
    return re.sub(r"^file:/(?!/)", "file:///", whole)


def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``pages (page_id, url, payload)`` and ``refers_to``.

    The first page of each payload is found by aggregation and joined back to the
    pages, whose side Spark splits where one payload has many. Payloads under
    ``min_bytes`` refer to nothing. Payloads are told apart by SHA-256 and length.
    """
    marked = pages.withColumn("_sha", F.sha2("payload", 256)).withColumn("_n", F.length("payload"))
    firsts = (
        marked.filter(F.col("_n") >= min_bytes)
        .groupBy("_sha", "_n")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    found = marked.join(firsts, ["_sha", "_n"], "left")
    same = F.col("page_id").eqNullSafe(F.col("_first"))
    return found.select(
        "page_id", "url", "payload", F.when(~same, F.col("_first")).alias("refers_to")
    )


def write_bundles(
    pages: DataFrame, folder: str, min_bytes: int = 0, bundling: Bundling = Bundling()
) -> DataFrame:
    """Archive ``pages (page_id, url, html)`` under ``folder``; the index as a lazy table.

    Store the index: a task writes its bundles as it is computed. Files have names of
    their own for every attempt, so a repeated task cannot mix its records with those
    of a lost one, and the index of the attempt that counted names only its own.
    A null html is an empty payload; equal ones under one page id are all responses;
    a page without id is never the first of its payload unless no other has one.
    ``folder`` must be one that driver and executors share.
    """
    folder = qualified(pages.sparkSession, folder)
    need = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        writer, bundle, number = None, "", 0
        held: list[tuple[str, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            where = writer.frame(b"".join(r for _, r in held))
            offset, rows = 0, []
            for id, r in held:
                rows.append((bundle, *where, offset, len(r), id))
                offset += len(r)
            held.clear()
            columns = list(zip(*rows, strict=True))
            types = (pa.string(), pa.int32(), *[pa.int64()] * 4, pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=INDEX.names
            )

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                page, url, payload, first = (x.as_py() for x in row)
                if writer is None:
                    bundle = f"{folder.rstrip('/')}/{name}-{number:04d}.warc.zst"
                    writer = BundleWriter(system.open_output_stream(_open(bundle)[1], compression=None), bundling.level)
                    number += 1
                held.append(record(page, url, payload, first, bundling.date))
                size += len(held[-1][1])
                if size >= bundling.frame_bytes:
                    yield flush()
                    size = 0
                    if writer.size >= bundling.bundle_bytes:
                        writer.close()
                        writer = None
        if held:
            yield flush()
        if writer is not None:
            writer.close()

    return revisits(need, min_bytes).mapInArrow(run, INDEX)


def read_bundles(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the bundles an index names, read by frame.

    A task seeks to its frames by the seek table in the bundle and to the records by
    their offsets; every response is checked against its digest (``intact``).
    """
    frames = index.groupBy("bundle", "frame").agg(
        F.sort_array(F.collect_list(F.struct("record_offset", "record_id"))).alias("records")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, table = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != path:
                    path = row["bundle"]
                    system, local = _open(path)
                    file = system.open_input_file(local)
                    table = seek_table(file)
                data = read_frame(file, table[row["frame"]])
                rows = []
                for place in row["records"]:
                    fields, block, _ = parse(data, place["record_offset"])
                    if fields["WARC-Record-ID"] != place["record_id"]:
                        raise ValueError("the index names another record")
                    split = block.index(b"\r\n\r\n") + 4
                    http, payload = block[:split].decode(), block[split:]
                    length = int(http.split("Content-Length: ", 1)[1].split("\r\n", 1)[0])
                    kind, sha = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    page, first = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
                    rows.append(
                        (
                            fields["WARC-Record-ID"],
                            None if page is None else int(page),
                            fields.get("WARC-Target-URI"),
                            kind,
                            None if first is None else int(first),
                            length,
                            sha,
                            payload if with_payload and kind == "response" else None,
                            fields["WARC-Block-Digest"] == "sha1:" + digest(block)
                            and (kind == "revisit" or (len(payload) == length and digest(payload) == sha)),
                        )
                    )
                types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=RECORD.names
                )

    return frames.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(run, RECORD)


def op5_warc_bundles(spark, sf: str) -> DataFrame:
    staging = Staging(spark)
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    index = staging.table(write_bundles(pages, staging.path("bundles")), "index")
    return read_bundles(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


QUERIES = {"op5_warc_bundles": op5_warc_bundles}
ORACLE: dict[str, str] = {}

"""WARC archives and their chunked record table.

Writing: payloads become rows (record, chunk number, at most ``CHUNK`` bytes) and
each task streams its chunk rows into gzip members of its own archive, updating
the SHA-1 as it goes.  A payload that several records share is written once, as
the response with the largest id; the others are revisits that refer to it.
The index (archive, offset, length, record) is a table; only archives of tasks
that ended well are in it.

Reading: the index cuts archives into runs of records of about ``READ_BYTES``, dealt
one a task; a task streams its run in pieces of ``CHUNK`` bytes and gives rows
(record, chunk number, position, running SHA-1, optionally the bytes); the last
row of a record holds the digest of the whole payload, which is compared with
the record's header; this side never holds a whole record.  Cutting payloads into
rows holds the row that a payload comes in, and beside it one chunk at a time.

Defined results: a null payload is empty; an empty payload is a payload like any
other; rows repeated with one id are records of their own (all responses if the
id is the largest); a null id is written as such and is smaller than every other
(records of one payload that all lack an id are all responses); an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import written

CHUNK = 256 << 10
ARCHIVE_BYTES = 512 << 20
READ_BYTES = 64 << 20  # a reading task's share of an archive
DATE = "2000-01-01T00:00:00Z"  # records carry no capture time; a fixed one keeps archives repeatable
CDX = "archive string, offset bigint, length bigint, record string"
CHUNKS = ("record string, record_type string, refers_to string, chunk_no bigint, position bigint, n_bytes bigint, "
          "running_sha1 string, is_last boolean, payload_bytes bigint, data binary")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def open_store(path: str):
    """(filesystem, path) of any store that pyarrow knows."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def record_kinds(pages: DataFrame, id_col: str, payload) -> DataFrame:
    """``r_id, r_sha1, keeper``: the ids that repeat the payload of ``keeper``."""
    narrow = pages.select(F.col(id_col).alias("r_id"), F.sha1(payload).alias("r_sha1"),
                          F.octet_length(payload).alias("r_bytes"))
    shared = (narrow.groupBy("r_sha1", "r_bytes").agg(F.max("r_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select(F.col("r_sha1").alias("k_sha1"), F.col("r_bytes").alias("k_bytes"), "keeper"))
    return (narrow.join(shared, (F.col("r_sha1") == F.col("k_sha1")) & (F.col("r_bytes") == F.col("k_bytes")))
            .where(~F.col("r_id").eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull())
            .select("r_id", "r_sha1", "keeper").distinct())


def chunk_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               chunk: int = CHUNK) -> DataFrame:
    """``record, url, record_type, refers_to, payload_bytes, sha1, chunk_no,
    data``; a revisit has one row without bytes, an empty payload one row."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    kinds = record_kinds(pages, id_col, payload)
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("sha1"))
    typed = base.join(kinds, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("sha1") == F.col("r_sha1")), "left")
    is_new = F.col("keeper").isNull()
    count = F.when(is_new, F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / chunk))).otherwise(F.lit(1))
    # Numbers are exploded, not chunks: each row cuts its own, so a record's chunks never lie in one array.
    cut = typed.select("*", F.explode(F.sequence(F.lit(0), count.cast("int") - 1)).alias("chunk_no"))
    return cut.select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("record"), "url",
        F.when(is_new, "response").otherwise("revisit").alias("record_type"),
        F.col("keeper").cast("string").alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), "sha1", "chunk_no",
        F.when(is_new, F.substring(F.col("payload"), F.col("chunk_no") * chunk + 1, F.lit(chunk)))
        .otherwise(F.lit(b"")).alias("data"))


def write_archives(chunks: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Stream chunk rows, each record's in order, into archives under ``path``;
    the index table, written beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, where = open_store(path)
        store.create_dir(where, recursive=True)
        out = name = member = sha = expected = None
        size = start = 0
        rows: list[tuple] = []

        def finish():
            """End the open record: its member, its index row."""
            nonlocal member, size
            if member is None:
                return
            tail = member[0].compress(b"\r\n\r\n") + member[0].flush()
            out.write(tail)
            size += len(tail)
            if expected and sha.hexdigest() != expected:
                raise ValueError(f"payload of record {member[1]} does not match its digest")
            rows.append((name, start, size - start, member[1]))
            member = None

        for b in batches:
            for r in b.to_pylist():
                if r["chunk_no"] == 0:
                    finish()
                    if out is not None and size >= archive_bytes:
                        out.close()
                        out = None
                    if out is None:
                        name, size = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{where}/{name.rsplit('/', 1)[1]}", compression=None)
                    member, start = (zlib.compressobj(6, zlib.DEFLATED, 31), r["record"]), size
                    sha, expected = hashlib.sha1(), r["sha1"] if r["record_type"] == "response" else None
                    out.write(head := member[0].compress(record_header(r)))
                    size += len(head)
                sha.update(r["data"])
                body = member[0].compress(r["data"])
                out.write(body)
                size += len(body)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                                 names=["archive", "offset", "length", "record"])
                rows.clear()
        finish()
        if out is not None:
            out.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                             names=["archive", "offset", "length", "record"])

    return written(chunks.mapInArrow(run, CDX), "cdx")


def record_header(r: dict) -> bytes:
    """WARC header and HTTP header of a record whose payload follows."""
    response = r["record_type"] == "response"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {r['payload_bytes']}\r\n\r\n").encode()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", r["url"] or "urn:none")
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <urn:record:{r['record']}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
             f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(r['sha1']))}",
             f"X-Payload-Length: {r['payload_bytes']}"]
    if not response:
        lines += [f"WARC-Refers-To: <urn:record:{r['refers_to']}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (r['payload_bytes'] if response else 0)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def stream_records(stream, chunk: int = CHUNK, with_data: bool = True) -> Iterator[tuple]:
    """Chunk rows of one archive, read and unpacked in pieces of ``chunk``."""
    raw, ended = b"", False
    unpack = zlib.decompressobj(31)
    plain = bytearray()

    def more() -> bool:
        """Unpack a further piece into ``plain``; False at the archive's end."""
        nonlocal raw, ended, unpack
        while True:
            if unpack.eof:
                raw, unpack = unpack.unused_data, zlib.decompressobj(31)
            if not raw and not ended:
                raw = stream.read(chunk)
                ended = not raw
            if not raw:
                return False
            got = unpack.decompress(raw, chunk)
            raw = b"" if unpack.eof else unpack.unconsumed_tail
            plain.extend(got)
            if got:
                return True

    def until(mark: bytes) -> bytes:
        while (at := plain.find(mark)) < 0:
            if not more():
                raise ValueError("archive ends inside a record")
        out = bytes(plain[:at])
        del plain[:at + len(mark)]
        return out

    while plain or more():
        warc = dict(x.split(": ", 1) for x in until(b"\r\n\r\n").decode().split("\r\n")[1:])
        http = until(b"\r\n\r\n")
        left = int(warc["Content-Length"]) - len(http) - 4
        total = int(warc["X-Payload-Length"])
        record, refers = (re.sub(r"^<urn:record:|>$", "", x) if x else None
                          for x in (warc["WARC-Record-ID"], warc.get("WARC-Refers-To")))
        said, kind = warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"]
        sha, number, at = hashlib.sha1(), 0, 0
        if kind == "revisit":
            yield record, kind, refers, 0, 0, 0, said, True, total, None
        while kind == "response":
            while len(plain) < min(chunk, left) and more():
                pass
            piece = bytes(plain[:min(chunk, left)])
            if len(piece) < min(chunk, left):
                raise ValueError("archive ends inside a record")
            del plain[:len(piece)]
            left -= len(piece)
            sha.update(piece)
            if not left and base32(sha.digest()) != said:
                raise ValueError(f"payload of record {record} does not match its digest")
            yield (record, kind, refers, number, at, len(piece), base32(sha.digest()), not left, total,
                   piece if with_data else None)
            number, at = number + 1, at + len(piece)
            if not left:
                break
        if until(b"\r\n\r\n"):
            raise ValueError(f"bytes after record {record}")


class _Run:
    """A file from one position to another, as a stream."""

    def __init__(self, file, first: int, end: int):
        file.seek(first)
        self.file, self.left = file, end - first

    def read(self, size: int) -> bytes:
        got = self.file.read(min(size, self.left))
        self.left -= len(got)
        return got


def read_chunks(cdx: DataFrame, chunk: int = CHUNK, with_data: bool = True, read_bytes: int = READ_BYTES) -> DataFrame:
    """The chunked record table of the archives in the index."""
    runs = written(cdx.groupBy("archive", F.floor(F.col("offset") / read_bytes).alias("no")).agg(
        F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("end")), "runs")
    names = CHUNKS.replace(" string", "").replace(" bigint", "").replace(" boolean", "").replace(" binary", "").split(", ")
    schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(),
                             "binary": pa.binary()}[t]) for n, t in (x.split() for x in CHUNKS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first, end in zip(*(b.column(c).to_pylist() for c in ("archive", "first", "end"))):
                store, where = open_store(path)
                rows, held = [], 0
                with store.open_input_file(where) as file:
                    for r in stream_records(_Run(file, first, end), chunk, with_data):
                        rows.append(r)
                        held += len(r[-1] or b"") + 100
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                             names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                     names=names)

    # A run is one unit of work: ranges over distinct keys put each into a partition of its own.
    ranged = runs.repartitionByRange(max(1, runs.count()), "archive", "no").select("archive", "first", "end")
    return ranged.mapInArrow(run, CHUNKS)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       payload_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back; one row
    per record from its last chunk."""
    spark: SparkSession = pages.sparkSession
    kind = pages.schema[id_col].dataType
    cdx = write_archives(chunk_rows(pages, id_col, url_col, payload_col), shared_path(spark, "warc"))
    back = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(kind)
    return read_chunks(cdx, with_data=False).where("is_last").select(
        back("record").alias(id_col), "payload_bytes", F.col("running_sha1").alias("payload_digest"), "record_type",
        back("refers_to").alias("refers_to"))

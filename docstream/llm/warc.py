"""WARC archives: written with an index of every record, read back by coalesced byte ranges.

Writing: each task writes one archive, record by record, each a gzip member of its own, and tells for every record
the file, offset, length, URL and digest. This index comes first in all reading: the records wanted are selected
in it, sorted by file and offset, neighbouring ranges are joined, and each joined range is one read.

Of the records with equal payloads of at least ``min_bytes`` bytes, that with the largest key is a response, the
others are revisits that name it and carry no payload; rows that repeat the response's key and payload are
responses too. A null payload counts as empty. A null key is smaller than any other; if all are null, all are
responses. A null URL is left out of the record. Empty tables give no archive and an empty index. Payloads may be
of any length. Other columns are not looked at.

Attempts that are repeated after a loss write archives under names of their own; the index names only those of the
attempts that counted. Folders are reached by Arrow's file systems, so they may be local, shared or in a store.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstream.llm.shipping import ship

INDEX = "file string, offset long, length long, url string, payload_digest string, payload_bytes long, record_type string, key long, refers_to long"
RECORDS = INDEX + ", payload binary"
#: Ranges closer than this are read as one; one read is not longer than the second, unless a record is.
GAP_BYTES, READ_BYTES = 1 << 16, 1 << 23
#: Bytes of archives that one task reads, about.
TASK_BYTES = 1 << 24
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
URN = "urn:x-record:"
_BAD = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, key: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes, date: str) -> bytes:
    """One record: header lines, an HTTP head and, for a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{URN}{'' if key is None else key}>",
        f"WARC-Date: {date}",
        *([] if url is None else ["WARC-Target-URI: " + _BAD.sub(lambda m: f"%{ord(m[0]):02X}", url)]),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(record: bytes) -> dict:
    """Header fields (lower-case names) and ``payload`` (None where the record carries none) of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
    body = rest[: int(fields.get("content-length", 0))]
    payload = body
    if "application/http" in fields.get("content-type", ""):
        payload = body.partition(b"\r\n\r\n")[2]
    fields["payload"] = payload if fields.get("warc-type") in ("response", "resource") else None
    return fields


def row_of(fields: dict) -> dict:
    """What the index tells of a record besides its place."""
    number = lambda name: int(m[1]) if (m := re.fullmatch(rf"<{URN}(-?\d+)>", fields.get(name, ""))) else None
    payload = fields["payload"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size = fields.get("x-payload-length")
    return {
        "url": fields.get("warc-target-uri"),
        "payload_digest": digest if payload is None else payload_digest(payload),
        "payload_bytes": len(payload) if payload is not None else None if size is None else int(size),
        "record_type": fields.get("warc-type"),
        "key": number("warc-record-id"),
        "refers_to": number("warc-refers-to"),
    }


def with_types(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``key``, ``url``, ``payload`` as UTF-8 bytes, its digest, and which response stands for it.

    Equal payloads are found by digest: counted in part before the shuffle; then one equi-join by digest, whose
    large partitions adaptive execution splits, so a payload that many rows share needs no task of its own.
    """
    hexed = F.sha1("payload")
    bits = [F.conv(F.substring(hexed, 1 + 5 * k, 5), 16, 10).cast("int") for k in range(8)]
    letter = lambda x, k: F.substring(F.lit(BASE32), (F.shiftright(x, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_digest", F.concat(*[letter(x, k) for x in bits for k in range(4)])).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    heads = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.max("key").alias("_head"), F.count("*").alias("_n"))
    # Few payloads are there twice; where these are few enough to be broadcast, no payload is shuffled.
    heads = heads.filter("_n > 1").drop("_n")
    joined = rows.join(heads, "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("_head").isNotNull() & ~F.col("key").eqNullSafe(F.col("_head"))
    return joined.select(
        "key",
        "url",
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "payload_digest",
        "payload_bytes",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("_head")).alias("refers_to"),
    )


def write_archives(typed: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes what ``with_types`` gives into archives under ``folder``; returns the saved index."""
    ship(typed.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, offset, path = None, 0, f"{folder}/archives/{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None:
                        store, inner = pafs.FileSystem.from_uri(path)
                        store.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(inner, compression=None)
                    record = record_bytes(row["record_type"], row["key"], row["url"], row["payload_digest"], row["payload_bytes"], row["refers_to"], row["payload"], date)
                    member = gzip.compress(record, 6, mtime=0)
                    out.write(member)
                    place = {"file": path, "offset": offset, "length": len(member)}
                    rows.append(place | {k: row[k] for k in ("url", "payload_digest", "payload_bytes", "record_type", "key", "refers_to")})
                    offset += len(member)
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
        finally:
            if out is not None:
                out.close()

    typed.mapInArrow(work, INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return typed.sparkSession.read.parquet(f"{folder}/index")


SCHEMA = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string())]
    + [("payload_bytes", pa.int64()), ("record_type", pa.string()), ("key", pa.int64()), ("refers_to", pa.int64())]
)


def members(stream, block: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a stream."""
    import zlib

    waiting, offset = b"", 0
    while True:
        unzip, content, used = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            data = waiting or stream.read(block)
            waiting = b""
            if not data:
                break
            content.append(unzip.decompress(data))
            waiting = unzip.unused_data
            used += len(data) - len(waiting)
        if not used or not unzip.eof:
            return
        yield offset, used, b"".join(content)
        offset += used


def index_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The index of archives written elsewhere, one gzip member a record: ``files`` has a column ``file`` of paths."""
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner = pafs.FileSystem.from_uri(path)
                with store.open_input_stream(inner, compression=None) as stream:
                    for offset, length, content in members(stream):
                        row = {"file": path, "offset": offset, "length": length} | row_of(parsed(content))
                        yield pa.RecordBatch.from_pylist([row], schema=SCHEMA)

    return files.select("file").mapInArrow(work, INDEX)


def ranges(places: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, int]]:
    """Sorted (offset, length) places as (first place, one past the last, end byte) of reads."""
    found: list[tuple[int, int, int]] = []
    for k, (offset, length) in enumerate(places):
        if found:
            first, _, end = found[-1]
            if offset - end <= gap and max(end, offset + length) - places[first][0] <= most:
                found[-1] = (first, k + 1, max(end, offset + length))
                continue
        found.append((k, k + 1, offset + length))
    return found


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the rows of ``index`` select, as the archives have them.

    Rows are dealt by ranges of (file, offset) and sorted, so a task reads each of its files once, forwards. How many
    tasks there are goes by the bytes to be read, not by the size of the index.
    """
    ship(index.sparkSession)
    schema = SCHEMA.append(pa.field("payload", pa.binary())) if payloads else SCHEMA

    def of_file(path: str, places: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        store, inner = pafs.FileSystem.from_uri(path)
        with store.open_input_file(inner) as source:
            for first, last, end in ranges(places):
                start = places[first][0]
                source.seek(start)
                data = source.read(end - start)
                rows = []
                for offset, length in places[first:last]:
                    fields = parsed(gzip.decompress(data[offset - start : offset - start + length]))
                    row = {"file": path, "offset": offset, "length": length} | row_of(fields)
                    rows.append(row | {"payload": fields["payload"]} if payloads else row)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, places = None, []
        for batch in batches:
            for own, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path is not None and own != path:
                    yield from of_file(path, places)
                    places = []
                path = own
                places.append((offset, length))
        if places:
            yield from of_file(path, places)

    n_bytes = index.agg(F.sum("length")).first()[0] or 0
    chosen = index.select("file", "offset", "length").repartitionByRange(-(-n_bytes // TASK_BYTES) or 1, "file", "offset").sortWithinPartitions("file", "offset")
    return chosen.mapInArrow(work, RECORDS if payloads else INDEX)

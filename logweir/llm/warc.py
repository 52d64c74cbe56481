"""WARC archives as a Spark data source, written and read in Python.

``spark.read.format("warc").load(folder)`` plans whole files into partitions of
similar size. A reader parses the headers of a record first, tests the pushed
filters on them, and decodes a payload only if the record is wanted and the option
``payload`` is not ``false``. In archives of this writer every record is a gzip
member that names its own length (the ``sl`` extra field), so a rejected record is
skipped without reading it; other archives (``.warc``, ``.warc.gz``) work as well.

A write makes files of bounded size under names of their own for each task attempt.
Only the manifest that ends the write makes them visible, so lost or repeated tasks
leave nothing that is read.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from logweir.llm.common import run_folder, stored, table, within_bound

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "warc_date string, payload_digest string, payload_bytes long, payload binary"
)
FIELDS = [part.split()[0] for part in SCHEMA.split(", ")]
ARROW = pa.schema(
    [
        (name, {"payload_bytes": pa.int64(), "payload": pa.binary()}.get(name, pa.string()))
        for name in FIELDS
    ]
)

FILE_BYTES = 128 << 20  # a writer starts a new file beyond this size
PLAN_BYTES = 64 << 20  # small files share a read partition up to this size
BATCH_BYTES = 8 << 20  # payload bytes in one Arrow batch, about
WINDOW = 1 << 20
MANIFEST = "_committed-"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), re.sub("^file:", "", path)


# --- one record ----------------------------------------------------------------


def _digest_name(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _digest_hex(name: str | None) -> str | None:
    """Lower-case hex of ``sha1:`` in base 32 or in hex."""
    if not name or not name.lower().startswith("sha1:"):
        return None
    value = name[5:]
    return value.lower() if len(value) == 40 else base64.b32decode(value).hex()


def _line(value: str) -> str:
    """Line ends can't stand in a header; they are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def encode_record(row: dict) -> bytes:
    """A record without compression; a revisit has the HTTP head only."""
    payload = row["payload"] or b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if row["record_type"] == "revisit" else http + payload
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Date": row["warc_date"],
        "WARC-Target-URI": row["target_uri"],
        "WARC-Refers-To": row["refers_to"],
        "WARC-Profile": PROFILE if row["record_type"] == "revisit" else None,
        "WARC-Payload-Digest": row["payload_digest"] and _digest_name(row["payload_digest"]),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {_line(v)}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    """A gzip member that holds its own length and that of ``data``."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    length = 10 + 2 + 12 + len(body) + 8
    if length >= 1 << 32 or len(data) >= 1 << 32:
        head = b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff"
    else:
        extra = b"sl" + struct.pack("<HII", 8, length, len(data))
        head = b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _headers(lines: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    name = ""
    for line in lines.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name:  # a folded line
            found[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, colon, value = line.partition(b":")
        if colon:
            name = key.strip().lower().decode("utf-8", "replace")
            found[name] = value.strip().decode("utf-8", "replace")
    return found


# --- reading -------------------------------------------------------------------


class Pieces:
    """Bytes of a file by position, read in pieces; skipped pieces are not read."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not (self.start <= at and at + n <= self.start + len(self.data)):
            self.start = at
            self.data = self.file.read_at(max(n, min(WINDOW, self.size - at)), at)
        return self.data[at - self.start : at - self.start + n]


class Member:
    """One record's bytes, decoded no further than asked for."""

    def __init__(self, window: Pieces, at: int):
        self.window, self.at, self.out, self.end = window, at, bytearray(), None
        self.length = None
        self.packed = window.get(at, 2) == b"\x1f\x8b"
        self.next = at
        if self.packed:
            self._gzip_head()
            self.inflate = zlib.decompressobj(-15)

    def _gzip_head(self) -> None:
        flags, at = self.window.get(self.at, 10)[3], self.at + 10
        if flags & 4:
            (n,) = struct.unpack("<H", self.window.get(at, 2))
            extra, k = self.window.get(at + 2, n), 0
            while k + 4 <= n:
                kind, (size,) = extra[k : k + 2], struct.unpack("<H", extra[k + 2 : k + 4])
                if kind == b"sl" and size == 8:
                    (self.length,) = struct.unpack("<I", extra[k + 4 : k + 8])
                k += 4 + size
            at += 2 + n
        for bit in (8, 16):  # name and comment
            if flags & bit:
                while self.window.get(at, 1) != b"\0":
                    at += 1
                at += 1
        self.next = at + 2 * bool(flags & 2)

    def more(self, n: int) -> bool:
        """Decode at least one and at most ``n`` further bytes; False at the end."""
        if self.end is not None:
            return False
        if not self.packed:
            piece = self.window.get(self.next, n)
            self.next += len(piece)
            self.out += piece
            return bool(piece)
        before = len(self.out)
        while len(self.out) == before and self.end is None:
            piece = self.window.get(self.next, min(n, WINDOW))
            if not piece:
                raise ValueError("a gzip member ends too early")
            self.out += self.inflate.decompress(piece, n)
            ended = self.inflate.eof
            left = self.inflate.unused_data if ended else self.inflate.unconsumed_tail
            self.next += len(piece) - len(left)
            if ended:
                crc, _ = struct.unpack("<II", self.window.get(self.next, 8))
                if crc != zlib.crc32(self.out):
                    raise ValueError("a record's checksum is wrong")
                self.end = self.next + 8
        return len(self.out) > before

    def until(self, mark: bytes, start: int = 0) -> int:
        """The place behind ``mark``, or -1 when the record ends without it."""
        while (found := self.out.find(mark, start)) < 0:
            start = max(start, len(self.out) - len(mark) + 1)
            if not self.more(1024):
                return -1
        return found + len(mark)

    def skip(self, body_end: int) -> int:
        """Where the next record starts."""
        if self.packed:
            if self.end is None and self.length is not None:
                return self.at + self.length
            while self.end is None:
                self.more(WINDOW)
            return self.end
        at = self.at + body_end
        while self.window.get(at, 2) == b"\r\n":
            at += 2
        return at


def records(window: Pieces, wanted, payload: bool) -> Iterator[dict]:
    """The wanted records of a file; ``wanted`` sees a record without payload."""
    at = 0
    while at < window.size:
        member = Member(window, at)
        head_end = member.until(b"\r\n\r\n")
        if head_end < 0:
            if bytes(member.out).strip():
                raise ValueError("a record without the end of its header")
            return
        head = _headers(bytes(member.out[:head_end]))
        block = int(head.get("content-length", 0))
        row = {
            "record_type": head.get("warc-type"),
            "record_id": head.get("warc-record-id"),
            "target_uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to"),
            "warc_date": head.get("warc-date"),
            "payload_digest": _digest_hex(head.get("warc-payload-digest")),
            "payload_bytes": None,
            "payload": None,
        }
        body, http_end = head_end, -1
        if head.get("content-type", "").startswith("application/http"):
            http_end = member.until(b"\r\n\r\n", head_end)
            if 0 < http_end <= head_end + block:
                http = _headers(bytes(member.out[head_end:http_end]))
                body = http_end
                length = http.get("content-length")
                row["payload_bytes"] = int(length) if length else None
        if row["payload_bytes"] is None:
            row["payload_bytes"] = head_end + block - body
        if wanted(row):
            if payload and row["record_type"] != "revisit":
                while len(member.out) < head_end + block and member.more(WINDOW):
                    pass
                row["payload"] = bytes(member.out[body : head_end + block])
            yield row
        at = member.skip(head_end + block)


# Filters on headers. Each takes (value, argument); null never passes.
_TESTS = {
    EqualTo: lambda x, y: x == y,
    GreaterThan: lambda x, y: x > y,
    GreaterThanOrEqual: lambda x, y: x >= y,
    LessThan: lambda x, y: x < y,
    LessThanOrEqual: lambda x, y: x <= y,
    In: lambda x, y: x in y,
    StringStartsWith: lambda x, y: x.startswith(y),
    StringEndsWith: lambda x, y: x.endswith(y),
    StringContains: lambda x, y: y in x,
}


def _test(item, row: dict) -> bool | None:
    if isinstance(item, Not):
        inner = _test(item.child, row)
        return None if inner is None else not inner
    value = row[item.attribute[0]]
    if isinstance(item, IsNull):
        return value is None
    if isinstance(item, IsNotNull):
        return value is not None
    if isinstance(item, EqualNullSafe):
        return value == item.value
    if value is None or item.value is None:
        return None
    return _TESTS[type(item)](value, item.value)


def _can_test(item) -> bool:
    if isinstance(item, Not):
        return _can_test(item.child)
    known = (*_TESTS, IsNull, IsNotNull, EqualNullSafe)
    return (
        isinstance(item, known)
        and len(item.attribute) == 1
        and item.attribute[0] in FIELDS
        and item.attribute[0] != "payload"
    )


@dataclass
class Files(InputPartition):
    files: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.filters: list = []

    def pushFilters(self, filters: list) -> Iterable:
        for item in filters:
            if _can_test(item):
                self.filters.append(item)
            else:
                yield item

    def partitions(self) -> list[Files]:
        """Files in bins of about ``PLAN_BYTES``; none at all is one empty bin."""
        bins: list[list] = [[]]
        filled = 0
        for name, size in archive_files(self.path):
            if bins[-1] and filled + size > PLAN_BYTES:
                bins.append([])
                filled = 0
            bins[-1].append((name, size))
            filled += size
        return [Files(files) for files in bins]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        def wanted(row: dict) -> bool:
            return all(_test(item, row) is True for item in self.filters)

        rows, held = [], 0
        fs, _ = file_system(self.path)
        for name, size in partition.files:
            with fs.open_input_file(name) as file:
                for row in records(Pieces(file, size), wanted, self.payload):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 200
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


def archive_files(path: str) -> list[tuple[str, int]]:
    """(file, bytes): those of the manifests, or all archives if there is none."""
    fs, folder = file_system(path)
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    manifests = [f for f in found if f.base_name.startswith(MANIFEST)]
    if manifests:
        names: list = []
        for manifest in manifests:
            with fs.open_input_stream(manifest.path) as stream:
                names += json.loads(stream.read())
        return sorted((f"{folder}/{name}", size) for name, size in names)
    return sorted(
        (f.path, f.size)
        for f in found
        if f.base_name.endswith((".warc", ".warc.gz")) and f.size
    )


# --- writing -------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        files: list = []
        out, name, size = None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                member = gzip_member(encode_record({k: row.get(k) for k in FIELDS}))
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        names = [file for message in messages if message for file in message.files]
        with fs.open_output_stream(f"{folder}/{MANIFEST}{self.run}.json") as stream:
            stream.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        for message in messages:
            for name, _ in message.files if message else []:
                fs.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages to archives and back --------------------------------------------------


def page_records(
    pages: DataFrame, min_bytes: int = 1000, warc_date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """A record per page: the first copy of a payload is the response.

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest
    page_id is a response and the others revisit it (rows that share this page_id
    are responses all; null ids never win over others). A null html is an empty
    payload, a null url has no target; further columns are not archived.
    """
    page = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1("payload"),
        }
    )
    shared = stored(
        page.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("first_"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first_").isNotNull())
        .drop("n")
    )
    again = F.col("first_").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_"))

    def urn(page_id: Column) -> Column:
        known = F.concat(F.lit("<urn:page:"), F.url_encode(page_id.cast("string")), F.lit(">"))
        return F.coalesce(known, F.lit("<urn:page>"))

    return page.join(within_bound(shared, shared.count()), "payload_digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(again, urn(F.col("first_"))).alias("refers_to"),
        F.lit(warc_date).alias("warc_date"),
        "payload_digest",
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def op7_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` and read them back: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``, ids in the type they have.

    Payloads of responses are decoded and digested anew; a revisit's length and
    digest stand in its headers.
    """
    spark, id_type = pages.sparkSession, pages.schema["page_id"].dataType.simpleString()
    register(spark)
    folder = run_folder(spark)
    page_records(pages).write.format("warc").mode("append").save(folder)

    def archive(payload: bool) -> DataFrame:
        return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)

    full = archive(True).filter("record_type = 'response'")
    whole = full.select(
        "record_id",
        "refers_to",
        "record_type",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha1("payload") == F.col("payload_digest"), F.col("payload_digest"))
        .otherwise(F.raise_error(F.lit("a payload does not match its digest")))
        .alias("payload_digest"),
    )
    heads = archive(False).filter("record_type = 'revisit'")
    both = whole.unionByName(
        heads.select("record_id", "refers_to", "record_type", "payload_bytes", "payload_digest")
    )

    return both.select(
        page_id_of("record_id", id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id_of("refers_to", id_type).alias("refers_to"),
    )


def page_id_of(name: str, id_type: str) -> Column:
    """The page id that a record's name stands for, in the ids' own type."""
    text = F.url_decode(F.regexp_extract(name, r"^<urn:page:(.*)>$", 1))
    return F.when(F.col(name) != "<urn:page>", text).cast(id_type)


OP7_SQL = """
WITH page AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages
),
judged AS (
    SELECT *, CASE WHEN payload_bytes >= 1000
                   THEN max(page_id) OVER (PARTITION BY payload_digest)
              END AS first_id
    FROM page
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM judged"""

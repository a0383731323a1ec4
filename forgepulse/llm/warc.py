"""WARC archives as a Spark data source, for reading and writing.

Every record is a gzip member of its own. Members written here carry their compressed
length in an extra field of the gzip header ("sl", as annex A of the WARC standard has
it), so a reader can step over a payload without inflating it; members of other writers
are inflated and thrown away instead.

Reading plans one partition per file, or several for a file longer than `split_bytes`:
a part begins at the first member at or after its offset. Predicates on the record type
and on headers are pushed into the source, which parses a record's headers first and
decodes the payload only of records that pass, and only if the schema asks for it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
    IsNotNull, WriterCommitMessage,
)

from forgepulse.llm.common import python_batches
from forgepulse.llm.files import listed, opened, renamed
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
# Columns and the headers they come from.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
MEMBER = b"\x1f\x8b\x08"
EXTRA = 4  # the flag bit of a gzip header with extra fields
FILE_BYTES = 128 << 20
SPLIT_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- members ---------------------------------------------------------------------------


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that states its own length and that of its content."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    head, tail = 10 + 2 + 4 + 8, 8
    length = head + len(body) + tail
    field = b"sl" + struct.pack("<HII", 8, length, len(data) & 0xFFFFFFFF)
    return (
        MEMBER + bytes([EXTRA]) + b"\0\0\0\0\0\xff" + struct.pack("<H", len(field)) + field
        + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    )


def stated_length(head: bytes) -> int | None:
    """The member's length by its `sl` field, if it has one."""
    if len(head) < 12 or not head[3] & EXTRA:
        return None
    extra = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]]
    while len(extra) >= 4:
        size = struct.unpack_from("<H", extra, 2)[0]
        if extra[:2] == b"sl" and size == 8 and len(extra) >= 12:
            return struct.unpack_from("<I", extra, 4)[0]
        extra = extra[4 + size :]
    return None


class Inflated:
    """The content of one member, inflated no further than it is asked for."""

    def __init__(self, file, at: int):
        self.file, self.at, self.read_to = file, at, at
        self.inflate = zlib.decompressobj(31)
        self.content = b""

    def more(self) -> bool:
        self.file.seek(self.read_to)
        data = self.file.read(1 << 16)
        if not data:
            return False
        self.read_to += len(data)
        self.content += self.inflate.decompress(data)
        return True

    def until(self, mark: bytes) -> int:
        """Where the content after the mark begins; -1 if there is none."""
        while (found := self.content.find(mark)) < 0:
            if self.inflate.eof or not self.more():
                return -1
        return found + len(mark)

    def all(self) -> bytes:
        parts = [self.content]
        while not self.inflate.eof:
            self.content = b""
            if not self.more():
                raise EOFError(f"the archive ends inside the record at byte {self.at}")
            parts.append(self.content)
        self.content = b"".join(parts)
        return self.content

    def end(self) -> int:
        """Where the next member begins, inflating what is left, block by block."""
        while not self.inflate.eof:
            self.content = b""
            if not self.more():
                raise EOFError(f"the archive ends inside the record at byte {self.at}")
        return self.read_to - len(self.inflate.unused_data)


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def first_member(file, at: int, end: int) -> int:
    """The first record that begins in [at, end), or `end`."""
    while at < end:
        file.seek(at)
        chunk = file.read(min(1 << 20, end - at + len(MEMBER) - 1))
        found = chunk.find(MEMBER)
        while found >= 0:
            try:
                if Inflated(file, at + found).until(b"WARC/1.") == len(b"WARC/1."):
                    return at + found
            except zlib.error:
                pass
            found = chunk.find(MEMBER, found + 1)
        at += max(1, len(chunk) - len(MEMBER) + 1)
    return end


def passes(values: dict, wanted: list[tuple[str, tuple]]) -> bool:
    return all(values.get(name) in allowed for name, allowed in wanted)


def records(
    file, start: int, end: int, columns: list[str], wanted: list[tuple[str, tuple]], verify: bool
) -> Iterator[tuple]:
    """Rows of the records that begin in [start, end) and pass.

    With `verify` their payloads are decoded and held against length and digest.
    """
    at = first_member(file, start, end) if start else 0
    while at < end:
        file.seek(at)
        head = file.read(64)
        if not head:
            return
        if head[:3] != MEMBER:
            raise ValueError(f"no gzip member at byte {at}")
        record = Inflated(file, at)
        split = record.until(b"\r\n\r\n")
        if split < 0:
            raise ValueError(f"no header block in the record at byte {at}")
        fields = headers(record.content[:split])
        row = {c: fields.get(name) for c, name in HEADERS.items()}
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        length = stated_length(head)
        if passes(row, wanted):
            if verify or {"payload", "payload_bytes"} & set(columns):
                row |= content(record, split, fields, verify or "payload" in columns)
            if verify and row["payload"] is not None:
                if (len(row["payload"]), digest(row["payload"])) != (row["payload_bytes"], row["payload_digest"]):
                    raise ValueError(f"the payload of {row['record_id']} is not the one that was written")
            yield tuple(row.get(c) for c in columns)
        at = at + length if length else record.end()


def content(record: Inflated, split: int, fields: dict, decode: bool) -> dict:
    """Payload and its length: what follows the HTTP headers, or the block if it has none."""
    block = int(fields.get("content-length", 0))
    http = "application/http" in fields.get("content-type", "")
    if not http and not decode:
        return {"payload_bytes": block}
    if http:
        record.until(b"\r\n\r\n") if not decode else record.all()
        while (inner := record.content.find(b"\r\n\r\n", split)) < 0 and record.more():
            pass
        # A revisit names the length of the payload it leaves out.
        stated = headers(record.content[split:inner]).get("content-length") if inner >= 0 else None
        begin = inner + 4
    else:
        record.all()
        stated, begin = None, split
    payload = record.content[begin : split + block] if decode else None
    size = int(stated) if stated is not None else len(payload or b"")
    if decode and fields.get("warc-type") == "revisit":
        payload = None
    return {"payload_bytes": size, "payload": payload}


def record_bytes(row: dict) -> bytes:
    """A response with its payload, or a revisit that refers to one."""
    payload = row["payload"] or b""
    revisit = row["refers_to"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {row['record_id']}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if row["target_uri"] is not None:
        # A line end in an address would end the header.
        lines.append("WARC-Target-URI: " + row["target_uri"].replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {row['refers_to']}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


# -- the source ------------------------------------------------------------------------


@dataclass
class Part(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path = options["path"]
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.verify = options.get("verify", "false").lower() == "true"
        self.columns = columns
        self.wanted: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take equality and membership on header columns; leave the rest to Spark."""
        column = lambda f: f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        taken = {id(f): f for f in filters if isinstance(f, EqualTo | In) and column(f) in HEADERS}
        for f in taken.values():
            self.wanted.append((column(f), tuple(f.value) if isinstance(f, In) else (f.value,)))
        sure = {name for name, _ in self.wanted}  # not null where they pass
        for f in filters:
            if id(f) not in taken and not (isinstance(f, IsNotNull) and column(f) in sure):
                yield f

    def partitions(self) -> list[Part]:
        found = [
            Part(name, at, min(size, at + self.split))
            for name, size in listed(self.path, (".warc.gz", ".warc"))
            for at in range(0, size, self.split)
        ]
        return found or [Part("", 0, 0)]

    def read(self, part: Part) -> Iterator[tuple]:
        if part.end > part.start:
            with opened(part.path, "rb") as file:
                yield from records(file, part.start, part.end, self.columns, self.wanted, self.verify)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each attempt of a task writes files of its own names, and commit gives those of the
    finished ones their archive suffix, so a task may run again."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, out, size = [], None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"{self.path}/{uuid.uuid4().hex}")
                    out, size = opened(files[-1] + ".part", "wb"), 0
                data = member(record_bytes(row))
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        for message in messages:
            for name in message.files if message else []:
                renamed(name + ".part", name + ".warc.gz")


class WarcSource(DataSource):
    """spark.read.format("warc").load(path); options split_bytes, file_bytes and verify."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, [f.name for f in schema.fields])

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# -- pages -----------------------------------------------------------------------------

RECORD = "<urn:forgepulse:page:%s>"


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records of pages (page_id, url, html): (record_id, target_uri, refers_to, payload).

    Of pages with equal payloads of at least `min_bytes`, the one with the smallest
    page_id is a response and the others refer to it. Equal length and equal SHA-1 stand
    for equal payloads. Rows that share all of page_id and payload, or have no page_id
    (these sort first), are told apart by nothing: the one of them that is smallest is
    one response, and repeats of it are responses as well.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"sha": F.sha1("payload"), "size": F.octet_length("payload")}
    )
    firsts = (
        keyed.where(F.col("size") >= min_bytes)
        .groupBy("sha", "size")
        .agg(F.min(F.struct("page_id")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    record = lambda c: F.format_string(RECORD, c)
    copy = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return keyed.join(firsts.hint("merge"), ["sha", "size"], "left").select(
        record(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(copy, record(F.col("first.page_id"))).alias("refers_to"),
        "payload",
    )


def archive_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per row of `pages` below `path`; without rows there is no archive.

    A null html is an empty payload, a null url leaves the header out. Other columns are
    left out.
    """
    register(pages.sparkSession)
    with python_batches(pages.sparkSession):
        page_records(pages, min_bytes).write.format("warc").mode("append").save(path)


def archived(spark: SparkSession, path: str, columns: str = SCHEMA, **options) -> DataFrame:
    """Records of the archives below `path`, with the given columns of `SCHEMA`."""
    register(spark)
    return spark.read.format("warc").options(**options).schema(columns).load(path)

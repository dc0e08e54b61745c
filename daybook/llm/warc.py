"""WARC archives as a Spark data source.

``spark.dataSource.register(WarcSource)`` makes ``format("warc")`` known. A row is a record.

Writing: every task writes archives of its own, a gzip member per record, and rolls them at
``maxFileBytes``; the commit names the finished files in a manifest, so files of failed or
repeated tasks are never read. Reading: files are planned into partitions of about
``maxPartitionBytes``. Equality and ``IN`` predicates on headers are pushed down; a record's
headers are parsed first, and the block of a record that they rule out, or of one of which
no payload is asked for (the schema names no ``payload``), is passed over without being kept
or decoded. Files are opened with ``pyarrow.fs``, so any store it knows will do.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, "
    "payload_digest string, refers_to string, payload_length long, payload binary"
)
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "WARC-Identified-Payload-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
CHUNK = 1 << 18
FILE_BYTES = 128 << 20
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:/"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if "://" not in path else path)
    return fs.LocalFileSystem(), path


# --- records ------------------------------------------------------------------


def one_line(value: object) -> str:
    """A header's value; line breaks would end the header."""
    return " ".join(str(value).splitlines()) if value is not None else ""


def record_bytes(row: dict) -> bytes:
    """A record as it is stored. The block holds an HTTP response; that of a revisit only its
    head, which tells the payload's length."""
    payload = row.get("payload") or b""
    length = row.get("payload_length")
    length = len(payload) if length is None else length
    revisit = row.get("record_type") == "revisit"
    kind = one_line(row.get("content_type")) or "application/octet-stream"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = one_line(row.get(column))
        if column in ("record_id", "refers_to") and value:
            value = f"<{value}>"
        if column == "payload_digest" and value:
            value = "sha1:" + base64.b32encode(bytes.fromhex(value)).decode()
        if value:
            lines.append(f"{header}: {value}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed_headers(head: bytes) -> dict[str, str]:
    """Header names in lower case; the first of names that repeat, continuation lines joined."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            if name in out:
                name = ""
            else:
                out[name] = value.strip()
    return out


def header_row(headers: dict[str, str]) -> dict[str, str | None]:
    row: dict[str, str | None] = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
    for column in ("record_id", "refers_to"):
        if row[column]:
            row[column] = row[column].removeprefix("<").removesuffix(">")
    digest = row["payload_digest"]
    if digest and digest.lower().startswith("sha1:") and len(digest) == 37:
        row["payload_digest"] = base64.b32decode(digest[5:].upper()).hex()
    return row


class Bytes:
    """The bytes of an archive, gzip or plain, in order; what is passed over is not kept."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        first = source.read(2)
        self.gzip = first == b"\x1f\x8b"
        self.inflater, self.inside = zlib.decompressobj(31), False
        self.raw, self.held = (first, b"") if self.gzip else (b"", first)

    def more(self) -> bool:
        """Adds to ``held``; False at the end of the archive."""
        while True:
            if not self.gzip:
                data = self.source.read(CHUNK)
                self.held += data
                return bool(data)
            if not self.raw:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    if self.inside:
                        raise EOFError("the archive ends inside a gzip member")
                    return False
            self.inside = True
            data = self.inflater.decompress(self.raw, CHUNK)
            self.raw = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self.raw, self.inflater, self.inside = self.inflater.unused_data, zlib.decompressobj(31), False
            if data:
                self.held += data
                return True

    def until(self, mark: bytes, within: int | None = None) -> bytes | None:
        """Up to and without ``mark``; None, and nothing is passed over, if it does not end in
        the next ``within`` bytes, or the archive ends first."""
        start = 0
        while (at := self.held.find(mark, start, within)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if within is not None and len(self.held) >= within or not self.more():
                return None
        found, self.held = self.held[:at], self.held[at + len(mark) :]
        return found

    def at_end(self) -> bool:
        """Passes over line ends; whether nothing follows."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            if self.held:
                return False
            if not self.more():
                return True

    def take(self, size: int) -> bytes:
        parts, got = [], 0
        while got < size:
            if not self.held and not self.more():
                raise EOFError("the archive ends inside a record")
            part, self.held = self.held[: size - got], self.held[size - got :]
            parts.append(part)
            got += len(part)
        return b"".join(parts)

    def skip(self, size: int) -> None:
        while size:
            if not self.held and not self.gzip:
                if self.source.tell() + size > self.source.size():
                    raise EOFError("the archive ends inside a record")
                self.source.seek(self.source.tell() + size)
                return
            if not self.held and not self.more():
                raise EOFError("the archive ends inside a record")
            gone = min(size, len(self.held))
            self.held = self.held[gone:]
            size -= gone


def records(
    source: pa.NativeFile, wanted: dict[str, set | None], payloads: bool, lengths: bool
) -> Iterator[dict]:
    """The records whose headers are among ``wanted``, the values of some columns, where None
    stands for any that is there. Without
    ``payloads`` their payload is None, without ``lengths`` their block is passed over.

    A block that says it is HTTP but has no end of a head is all payload. An archive that ends
    inside a record is an error.
    """
    data = Bytes(source)
    while not data.at_end():
        head = data.until(b"\r\n\r\n")
        if head is None:
            raise EOFError("the archive ends inside a record's headers")
        headers = parsed_headers(head)
        row: dict = header_row(headers)
        rest = size = int(headers.get("content-length", "0"))
        if any(row[c] is None or values and row[c] not in values for c, values in wanted.items()):
            data.skip(size)
            continue
        if payloads or lengths:
            row["payload_length"] = size
            http = headers.get("content-type", "").startswith("application/http")
            if http and (http_head := data.until(b"\r\n\r\n", size)) is not None:
                told = parsed_headers(http_head).get("content-length", "")
                rest = size - len(http_head) - 4
                row["payload_length"] = int(told) if told.isdigit() else rest
        if payloads and row["record_type"] != "revisit":
            row["payload"] = data.take(rest)
        else:
            data.skip(rest)
        yield row


# --- data source --------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcSource(DataSource):
    """Options: the path; ``maxPartitionBytes`` and ``maxFileBytes``. Own schemas may name any
    of the columns of ``SCHEMA``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.fields = schema
        self.path = options["path"]
        self.most = int(options.get("maxPartitionBytes", PARTITION_BYTES))
        self.wanted: dict[str, set | None] = {}
        self.nothing = False

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            known = column in HEADERS and getattr(f, "value", "") is not None
            if not known or not isinstance(f, (EqualTo, EqualNullSafe, In, IsNotNull)):
                yield f
                continue
            if isinstance(f, IsNotNull):
                self.wanted.setdefault(column)
                continue
            values = set(f.value) - {None} if isinstance(f, In) else {f.value}
            self.wanted[column] = values & (self.wanted.get(column) or values)
            self.nothing = self.nothing or not self.wanted[column]

    def files(self) -> list[tuple[str, int]]:
        """Files and sizes: those of the manifest, or all if there is none."""
        store, root = opened(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            return [(root, info.size)]
        if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as source:
                return [(f"{root}/{name}", size) for name, size in json.loads(source.read())]
        found = store.get_file_info(fs.FileSelector(root))
        names = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "_."]
        return sorted((f.path, f.size) for f in names)

    def partitions(self) -> list[Files]:
        """Files in order, as many to a partition as fit."""
        out: list[Files] = []
        room = 0
        for path, size in self.files():
            if size > room or not out:
                out.append(Files([]))
                room = self.most
            out[-1].paths.append(path)
            room -= size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        names = self.fields.names
        types = {"payload": pa.binary(), "payload_length": pa.int64()}
        schema = pa.schema([(n, types.get(n, pa.string())) for n in names])
        rows, held = [], 0
        for path in [] if self.nothing else partition.paths:
            with store.open_input_file(path) as source:
                for row in records(source, self.wanted, "payload" in names, "payload_length" in names):
                    rows.append({n: row.get(n) for n in names})
                    held += len(row.get("payload") or b"") + 500
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.most = int(options.get("maxFileBytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        sink, name, size = None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if sink is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                squeezer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = squeezer.compress(record_bytes(row)) + squeezer.flush()
                sink.write(member)
                size += len(member)
                if size >= self.most:
                    sink.close()
                    done.append((name, size))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((name, size))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(tuple(f) for m in messages if m for f in m.files)
        known = store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File
        if known and not self.overwrite:
            with store.open_input_stream(f"{root}/{MANIFEST}") as source:
                files = [tuple(f) for f in json.loads(source.read())] + files
        with store.open_output_stream(f"{root}/{MANIFEST}") as sink:
            sink.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        for message in messages:
            for name, _ in message.files if message else []:
                store.delete_file(f"{root}/{name}")


# --- operators ----------------------------------------------------------------


def write_warc(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Writes ``rows``, which may have any of the columns of ``SCHEMA``, as WARC records."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").mode(mode).save(path)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """The records at ``path``; ``columns`` is the part of ``SCHEMA`` to read."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(columns).load(path)


def page_records(pages: DataFrame, least_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Records of ``pages (page_id, url, html)``: of those with equal payloads of at least
    ``least_bytes``, the one with the largest id is the response that the others revisit.

    A null html is an empty payload; shorter payloads are all responses. A null id is smaller
    than others; if ids repeat, all rows of the largest are responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    rows = rows.withColumn("payload_length", F.octet_length("payload").cast("long"))
    long_ones = rows.where(F.col("payload_length") >= least_bytes)
    first = long_ones.groupBy(F.col("payload_digest").alias("_digest")).agg(F.max("page_id").alias("_first"))
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_length") >= least_bytes)
    rows = rows.join(first, same, "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.select(
        name("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        "payload_digest",
        F.when(revisit, name("_first")).alias("refers_to"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )

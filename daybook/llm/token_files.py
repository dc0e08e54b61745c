"""Token ids as flat binary files that can be mapped into memory.

``spark.dataSource.register(TokenSource)`` makes ``format("tokens")`` known. A data set is a
folder with a manifest and, for every file number, three files:

``<name>.bin``   ids one after the other, unsigned 16-bit integers, or 32-bit ones if the
                 tokenizer has more ids; little-endian, no header
``<name>.idx``   64-bit offsets into it, one more than documents
``<name>.keys``  the documents' keys, an Arrow file

The files continue each other in the order of the rows' partitions. Every task writes files of
its own; the commit names those of the tasks that succeeded in the manifest, with the ids and
documents before each file, which are prefix sums over a line per file. So a document's place
in the whole corpus is its file's base plus its offset, and files of failed or repeated tasks
are never read. Reading is planned by the manifest: a large file is read in parts, as offsets
tell where any document lies.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from daybook.llm.common import given
from daybook.llm.pieces import BYTES_AT_ONCE, PieceIds, added_strings, cut_pieces
from daybook.llm.units import gathered, loaded_once, slices

SCHEMA = "key long, start long, n_tokens long, ids array<int>, id_bytes binary"
MANIFEST = "_manifest.json"
FILE_BYTES = 1 << 30
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
SEED = 12


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it; files of a local one are mapped when read."""
    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(use_mmap=True), urlparse(path).path
    return fs.FileSystem.from_uri(path)


# --- tokenizing ---------------------------------------------------------------

def tokenizer_of(path: str, special: bool):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = not special
    return made, byte_sizes(made)


def byte_sizes(tokenizer) -> np.ndarray:
    """How many bytes each id of a byte-level tokenizer stands for: a character of an entry is a
    byte, but those of added tokens are themselves."""
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        sizes[number] = len(entry)
    for number, token in tokenizer.get_added_tokens_decoder().items():
        sizes[number] = len(token.content.encode())
    return sizes


def with_token_ids(
    documents: DataFrame, tokenizer: str, end_id: int | None, text: str = "text", special: bool = True
) -> DataFrame:
    """``documents`` with ``ids``: the ids of the whole text, then ``end_id``, if one is given.

    ``tokenizer`` is the file of a byte-level tokenizer, to be found there by every executor.
    Strings of special tokens in a text become their ids unless ``special`` is false; no other
    special token is added. A null text is an empty one. Each row is its own document, also if
    ids or texts repeat, and stays where it is; other columns are passed on, an own column
    ``ids`` is replaced. A text is cut into pieces, the ids of which a worker keeps.
    """
    rows = given(documents, ["ids"], _text=F.coalesce(F.col(text).cast("string"), F.lit("")))
    whole = rows.schema["given"].dataType.simpleString()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made, id_bytes = loaded_once(f"{tokenizer} {special}", lambda: tokenizer_of(tokenizer, special))

        def encoded(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in made.encode_batch_fast(texts, add_special_tokens=False)]

        added = loaded_once(f"{tokenizer} {special} added", lambda: added_strings(made))
        # a worker keeps its pieces from task to task
        inner = loaded_once(f"{tokenizer} {special} pieces", lambda: PieceIds(encoded, id_bytes, added is not None))
        end = np.array([] if end_id is None else [end_id], np.int32)
        for batch in batches:
            for low, high in slices(batch.column(1), BYTES_AT_ONCE):
                part = batch.slice(low, high - low)
                words, pieces, ends = cut_pieces(part.column(1), added)
                flat, starts, sizes = inner.of(words)
                # after the last piece of a text comes the end
                starts, sizes, flat = np.r_[starts, len(flat)], np.r_[sizes, len(end)], np.r_[flat, end]
                pieces = np.insert(pieces, ends, len(words))
                flat = flat[gathered(starts, sizes, pieces)]
                upto = np.cumsum(sizes[pieces])[ends + np.arange(len(ends))]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, upto], pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["given", "ids"])

    return rows.mapInArrow(stream, f"given {whole}, ids array<int>").select("given.*", "ids")


# --- data source --------------------------------------------------------------


@dataclass
class Part(InputPartition):
    """Documents ``first`` to ``last`` of a file, before which lie ``base`` ids."""

    name: str
    base: int
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list[tuple[str, int, int]]


class TokenSource(DataSource):
    """Options: the path; ``width`` (bytes of an id, 2 or 4), ``maxFileBytes`` and
    ``maxPartitionBytes``. Rows to write have a ``key`` and ``ids``; schemas to read may name
    any of the columns of ``SCHEMA``, ``key`` with the type it was written with. ``id_bytes``
    are the ids as little-endian unsigned 32-bit integers."""

    @classmethod
    def name(cls) -> str:
        return "tokens"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TokenReader:
        return TokenReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options, overwrite)


def manifest_of(path: str) -> dict:
    store, root = opened(path)
    if store.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.File:
        raise FileNotFoundError(f"no finished token files in {path}")
    with store.open_input_stream(f"{root}/{MANIFEST}") as source:
        return json.loads(source.read())


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.kind = {2: "<u2", 4: "<u4"}[int(options.get("width", 4))]
        self.most = int(options.get("maxFileBytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int, int]] = []
        sinks, name, docs, tokens = [], "", 0, 0

        def close() -> None:
            for sink in reversed(sinks):
                sink.close()
            done.append((name, docs, tokens))

        for batch in iterator:
            keys, lists = batch.column("key"), batch.column("ids")
            if not batch.num_rows:
                continue
            if not sinks:
                name, docs, tokens = uuid.uuid4().hex, 0, 0
                flat, index, place = [
                    store.open_output_stream(f"{root}/{name}.{x}", compression=None) for x in ("bin", "idx", "keys")
                ]
                table = pa.ipc.new_file(place, pa.schema([("key", keys.type)]))
                sinks = [flat, index, place, table]
                index.write(np.zeros(1, "<i8").tobytes())
            offsets = lists.offsets.to_numpy().astype("<i8")
            ids = lists.flatten().to_numpy()
            if len(ids) and (ids.min() < 0 or ids.max() > np.iinfo(self.kind).max):
                raise ValueError(f"an id does not fit into {self.kind}")
            flat.write(ids.astype(self.kind).tobytes())
            index.write((offsets[1:] - offsets[0] + tokens).tobytes())
            table.write_batch(pa.RecordBatch.from_arrays([keys], ["key"]))
            docs += batch.num_rows
            tokens += len(ids)
            if tokens * np.dtype(self.kind).itemsize >= self.most:
                close()
                sinks = []
        if sinks:
            close()
        return Written(TaskContext.get().partitionId(), done)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        store.create_dir(root, recursive=True)
        old = []
        if not self.overwrite and store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            held = manifest_of(self.path)
            if held["kind"] != self.kind:
                raise ValueError(f"{self.path} has ids of another width")
            old = [f[:3] for f in held["files"]]
        new = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        files, before_docs, before = [], 0, 0
        for name, docs, tokens in [*old, *new]:
            files.append([name, docs, tokens, before_docs, before])
            before_docs, before = before_docs + docs, before + tokens
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as sink:
            sink.write(json.dumps({"kind": self.kind, "files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        for name, _, _ in [f for m in messages if m for f in m.files]:
            for kind in ("bin", "idx", "keys"):
                store.delete_file(f"{root}/{name}.{kind}")


class TokenReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.fields, self.path = schema, options["path"]
        self.most = int(options.get("maxPartitionBytes", PARTITION_BYTES))
        self.manifest = manifest_of(self.path)

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        width = np.dtype(self.manifest["kind"]).itemsize
        for name, docs, tokens, _, base in self.manifest["files"]:
            parts = min(docs, -(-tokens * width // self.most)) or 1
            edges = [docs * k // parts for k in range(parts + 1)]
            out += [Part(name, base, a, b) for a, b in zip(edges, edges[1:], strict=False)]
        return out or [Part("", 0, 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.last == partition.first:
            return
        store, root = opened(self.path)
        names = self.fields.names
        schema = to_arrow_schema(self.fields)
        kind = np.dtype(self.manifest["kind"])
        with store.open_input_file(f"{root}/{partition.name}.idx") as source:
            source.seek(8 * partition.first)
            offsets = np.frombuffer(source.read_buffer(8 * (partition.last - partition.first + 1)), "<i8")
        keys = None
        if "key" in names:
            with store.open_input_file(f"{root}/{partition.name}.keys") as source:
                keys = pa.ipc.open_file(source).read_all()["key"]
                keys = keys.slice(partition.first, partition.last - partition.first).combine_chunks()
        with store.open_input_file(f"{root}/{partition.name}.bin") as source:
            at, wanted = 0, BATCH_BYTES // kind.itemsize
            while at < len(offsets) - 1:
                upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + wanted, "right")) - 1)
                own = offsets[at : upto + 1]
                columns = {
                    "start": lambda own=own: pa.array(own[:-1] + partition.base),
                    "n_tokens": lambda own=own: pa.array(np.diff(own)),
                    "key": lambda at=at, upto=upto: keys.slice(at, upto - at),
                }
                if "ids" in names or "id_bytes" in names:
                    source.seek(kind.itemsize * int(own[0]))
                    ids = np.frombuffer(source.read_buffer(kind.itemsize * int(own[-1] - own[0])), kind)
                    local = (own - own[0]).astype(np.int32)
                    columns["ids"] = lambda ids=ids, local=local: pa.ListArray.from_arrays(
                        pa.array(local), pa.array(ids.astype(np.int32))
                    )
                    columns["id_bytes"] = lambda ids=ids, local=local: pa.BinaryArray.from_buffers(
                        pa.binary(), len(local) - 1, [None, pa.py_buffer(local * 4), pa.py_buffer(ids.astype("<u4"))]
                    )
                yield pa.RecordBatch.from_arrays([columns[n]().cast(schema.field(n).type) for n in names], schema=schema)
                at = upto


# --- operators ----------------------------------------------------------------


def write_tokens(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None,
    key: str = "doc_id",
    text: str = "text",
    special: bool = True,
    width: int = 2,
) -> None:
    """Writes the ids of all whole texts to ``path``, in ascending order of ``key``.

    Null keys come first and stay null; rows with equal keys are documents of their own, in the
    order of a hash of their texts, and may be as many as they like: rows are dealt out by
    ranges of key, hash and a random number. A null or empty text has only ``end_id``. Other
    columns are not written. An empty table is a manifest of no files.
    """
    documents.sparkSession.dataSource.register(TokenSource)
    rows = documents.select(
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("_hash"),
        F.rand(SEED).alias("_any"),
    )
    order = ["key", "_hash", "_any"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    ids = with_token_ids(rows, tokenizer, end_id, special=special).select("key", "ids")
    ids.write.format("tokens").option("width", str(width)).mode("overwrite").save(path)


def read_tokens(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """A row per document of the files at ``path``: its key, the ids before it, how many it has,
    and the ids themselves; ``columns`` is the part of ``SCHEMA`` to read."""
    spark.dataSource.register(TokenSource)
    return spark.read.format("tokens").schema(columns).load(path)

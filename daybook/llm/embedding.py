"""Near-duplicate vectors by cosine.

Vectors are hashed by the signs of their products with random directions, ``bits`` of them
per table, and compared where they share a table's signature. Two vectors at the angle of
the threshold share a sign with probability 1 - angle / pi; the number of tables follows
from the number of bits so that such a pair is missed with a probability of at most
``MISS``, and closer ones less. The number of bits follows from the number of vectors, so
that unrelated vectors seldom share a signature.

Vectors meet twice. First only their signs do: a row per table holds the id and a sketch, the
first ``SKETCH_BITS`` signs, and pairs whose sketches differ in more bits than a pair at the
threshold does, but for a probability of ``SKETCH_MISS``, go. So do pairs that met at an earlier
table of the sketch. Then the vectors that are left over in some pair are fetched and compared
exactly, each with those it was left over with.

Equal vectors are one vector with a count from the start. A signature that many vectors
share is cut into blocks, and each pair of blocks is a task of its own. A pair counts only
at the first table where it meets, so nothing has to be brought together again to count
links: tasks return a number per vector, and links that connect what they found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import if_small, saved
from daybook.llm.graph import connected_components

THRESHOLD = 0.95
MISS = 1e-4
PER_SIGNATURE = 24
"""How many unrelated vectors should share a signature at most."""
BLOCK = 2048
SKETCH_BITS = 256
SKETCH_MISS = 1e-6
SEED = 9

#: What tells a task: table and length of the vectors, signature, and a pair of blocks.
TASK = ["place", "mark", "tile"]


def table_plan(vectors: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits per table and number of tables."""
    bits = min(40, max(8, math.ceil(math.log2(max(1, vectors / PER_SIGNATURE)))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def most_differences(bits: int, threshold: float = THRESHOLD, miss: float = SKETCH_MISS) -> int:
    """How many of ``bits`` signs may differ, so that a pair at the threshold differs in more
    with a probability of at most ``miss``."""
    odds = math.acos(threshold) / math.pi
    over, most = 1.0, -1
    while over > miss and most < bits:
        most += 1
        over -= math.comb(bits, most) * odds**most * (1 - odds) ** (bits - most)
    return most


def directions(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    wide = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A long per vector and table."""
    signs = vectors @ directions(vectors.shape[1], bits, tables) > 0
    weights = 1 << np.arange(bits, dtype=np.int64)
    return signs.reshape(len(vectors), tables, bits) @ weights


def with_signatures(distinct: DataFrame, bits: int, tables: int) -> DataFrame:
    """``distinct (id, copies, vector)`` with ``width``, the vector's length, ``marks``, an array
    of a signature per table, and ``signs``, the same as bits, filled up to whole words."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy()
            marks = np.zeros((len(lists), tables), np.int64)
            flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = flat[(ends[at] - size)[:, None] + np.arange(size)]
                marks[at] = signatures(unit_rows(rows), bits, tables)
            offsets = np.arange(0, marks.size + 1, tables, dtype=np.int32)
            column = pa.ListArray.from_arrays(offsets, marks.reshape(-1))
            bits_of = (marks[:, :, None] >> np.arange(bits)) & 1
            words = np.zeros((len(marks), -(-bits * tables // 64) * 64), np.uint8)
            words[:, : bits * tables] = bits_of.reshape(len(marks), -1)
            signs = pa.array([row.tobytes() for row in np.packbits(words, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int32()), column, signs],
                ["id", "copies", "vector", "width", "marks", "signs"],
            )

    return distinct.mapInArrow(
        stream, "id long, copies long, vector array<double>, width int, marks array<long>, signs binary"
    )


def marks_of(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The signatures of the first ``tables`` tables, of rows of bytes."""
    held = np.unpackbits(signs, axis=1, count=bits * tables).reshape(len(signs), tables, bits)
    return held.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def unmeet(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Clears pairs in ``near`` whose signatures, a column per earlier table, are equal somewhere."""
    if a.shape[1]:
        x, y = np.nonzero(near)
        for at in range(0, len(x), 1 << 16):
            p, q = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
            met = (a[p] == b[q]).any(axis=1)
            near[p[met], q[met]] = False


def sides(first: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The rows of both blocks of a task, or twice those of the one."""
    a = np.flatnonzero(first)
    return (a, a) if same else (a, np.flatnonzero(~first))


def may_link(words: np.ndarray, first: np.ndarray, same: bool, table: int, bits: int, most: int) -> np.ndarray:
    """Of the rows of one task, by their sketches, those that have someone to be compared with."""
    a, b = sides(first, same)
    left = np.zeros(len(words), bool)
    if not (len(a) and len(b)):
        return left
    near = np.empty((len(a), len(b)), bool)
    step = max(1, (1 << 20) // len(b))
    for at in range(0, len(a), step):
        apart = np.zeros((len(a[at : at + step]), len(b)), np.uint16)
        for k in range(words.shape[1]):
            apart += np.bitwise_count(words[a[at : at + step], k][:, None] ^ words[b, k])
        near[at : at + step] = apart <= most
    if b is a:
        np.fill_diagonal(near, False)
    if near.any():
        known = min(table, words.shape[1] * 64 // bits)
        marks = marks_of(words.view(np.uint8), bits, known)
        unmeet(near, marks[a], marks[b])
        left[a] |= near.any(axis=1)
        left[b] |= near.any(axis=0)
    return left


def compared(
    ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, marks: np.ndarray, first: np.ndarray,
    same: bool, threshold: float,
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links per vector, copies counted, and links that connect what is linked, of one task:
    of the rows of one block, or of those in one block with those in the other. ``marks`` are
    the signatures of earlier tables."""
    a, b = sides(first, same)
    if not (len(a) and len(b)):
        return np.zeros(len(ids), np.int64), []
    vectors = unit_rows(vectors)
    near = vectors[a] @ vectors[b].T >= threshold
    if b is a:
        np.fill_diagonal(near, False)
    unmeet(near, marks[a], marks[b])
    links = np.zeros(len(ids), np.int64)
    links[a] = near @ copies[b]
    if b is not a:
        links[b] = near.T @ copies[a]
    return links, spanning(near, ids[a], ids[b], b is a)


def spanning(near: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """A forest over the rows ``a`` and columns ``b`` of ``near``."""
    out: list[tuple[int, int]] = []
    new_a, new_b = np.ones(len(a), bool), np.ones(len(b), bool)
    for start in np.flatnonzero(near.any(axis=1)):
        if not new_a[start]:
            continue
        new_a[start] = False
        todo = [(0, start)]
        if same:
            new_b = new_a
        while todo:
            side, at = todo.pop()
            row, fresh = (near[at], new_b) if side == 0 else (near[:, at], new_a)
            found = np.flatnonzero(row & fresh)
            fresh[found] = False
            own, other = (a, b) if side == 0 else (b, a)
            out += [(int(own[at]), int(other[k])) for k in found]
            todo += [(0 if same else 1 - side, k) for k in found]
    return out


def block_tasks(marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per vector, table and task in which it is compared, with its sketch.

    Only signatures of more than ``block`` vectors are cut; those are few and are looked up.
    """
    place = F.shiftleft(F.col("table").cast("long"), 32) + F.col("width")
    sketch = F.substring("signs", 1, SKETCH_BITS // 8).alias("sketch")
    rows = marked.select("id", sketch, "width", F.posexplode("marks").alias("table", "mark"))
    rows = rows.select(place.alias("place"), "mark", "id", "sketch")
    hot = rows.groupBy(F.col("place").alias("_place"), F.col("mark").alias("_mark")).agg(F.count("*").alias("size"))
    hot = hot.where(F.col("size") > block)
    hot = saved(hot.select("_place", "_mark", F.ceil(F.col("size") / float(block)).cast("int").alias("_blocks")), "hot")
    same = (F.col("place") == F.col("_place")) & (F.col("mark") == F.col("_mark"))
    rows = rows.join(if_small(hot), same, "left").withColumn("blocks", F.coalesce("_blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "id"), "blocks").cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("place", "mark", "id", "sketch", "block", others)
    tile = F.shiftleft(F.least("block", "other").cast("long"), 32) + F.greatest("block", "other")
    return rows.select("place", "mark", tile.alias("tile"), (F.col("block") <= F.col("other")).alias("first"), "id", "sketch")


def by_task(rows: DataFrame, work: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``work(rows, starts, ends)`` on whole tasks, brought together and in order."""

    def cuts(rows: pa.Table) -> np.ndarray:
        """Where tasks start, but for the first."""
        keys = [rows.column(k).to_numpy() for k in range(len(TASK))]
        return 1 + np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))

    def results(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        return iter(work(rows, np.r_[0, starts], np.r_[starts, rows.num_rows]).to_batches())

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            starts = cuts(held)
            if len(starts):
                yield from results(held.slice(0, starts[-1]), starts[:-1])
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from results(held, cuts(held))

    return rows.repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(stream, schema)


def task_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table, whether both blocks are one, and whether a row is of the first, row by row."""
    place, tile = rows["place"].to_numpy(), rows["tile"].to_numpy()
    return place >> 32, tile >> 32 == tile & 0xFFFFFFFF, rows["first"].combine_chunks().to_numpy(zero_copy_only=False)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Binaries of one length as rows of bytes."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.uint8).reshape(len(parts), -1)


def candidates(tasks: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """The rows of ``tasks``, without their sketches, that have someone to be compared with."""
    most = most_differences(min(SKETCH_BITS, bits * tables), threshold)

    def work(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
        table, same, first = task_of(rows)
        words = matrix(rows["sketch"]).view(np.uint64)
        left = np.zeros(rows.num_rows, bool)
        for start, end in zip(starts, ends, strict=True):
            if end - start > 1:
                left[start:end] = may_link(
                    words[start:end], first[start:end], bool(same[start]), int(table[start]), bits, most
                )
        return rows.drop_columns(["sketch"]).filter(pa.array(left))

    return by_task(tasks, work, "place long, mark long, tile long, first boolean, id long")


def found_links(tasks: DataFrame, bits: int, threshold: float) -> DataFrame:
    """``(a, b, links)``: links of ``a`` where ``b`` is null, else a link. ``tasks`` are
    candidates with their vectors, copies and signs."""

    def work(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
        table, same, first = task_of(rows)
        ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
        lists, signs = rows["vector"].combine_chunks(), matrix(rows["signs"])
        flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        begins = np.cumsum(lengths) - lengths
        counted, links = [], []
        for start, end in zip(starts, ends, strict=True):
            if end - start > 1:
                wide = flat[begins[start] : begins[end - 1] + lengths[end - 1]].reshape(end - start, -1)
                n, found = compared(
                    ids[start:end], copies[start:end], wide, marks_of(signs[start:end], bits, int(table[start])),
                    first[start:end], bool(same[start]), threshold,
                )
                counted.append((ids[start:end][n > 0], n[n > 0]))
                links += found
        a = np.concatenate([ids[:0], *[x for x, _ in counted]])
        n = np.concatenate([copies[:0], *[x for _, x in counted]])
        return pa.table(
            {
                "a": np.concatenate([a, np.array([x for x, _ in links], np.int64)]),
                "b": pa.array([None] * len(a) + [x for _, x in links], pa.int64()),
                "links": np.concatenate([n, np.zeros(len(links), np.int64)]),
            }
        )

    return by_task(tasks, work, "a long, b long, links long")


def near_vectors(
    embeddings: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per row of ``embeddings``.

    Cosines are in double precision. A vector that is null, empty, zero or has a component
    that is null or not finite links with nothing and is its own component; so do vectors of
    different lengths. Equal vectors are linked with each other. A row with a null key links
    with nothing and is not kept; rows that share a key but not a vector count as one in
    components. Other columns play no part.
    """
    rows = embeddings.select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    usable = F.expr(
        "vec_id IS NOT NULL AND coalesce(forall(vector, x -> x IS NOT NULL AND abs(x) < double('Infinity')) "
        "AND exists(vector, x -> x <> 0D), false)"
    )
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    marks = [F.xxhash64(F.lit(k), "vector") for k in range(2)]
    rows = saved(rows.withColumns({"h0": marks[0], "h1": marks[1]}), "vectors")
    good = rows.where("vector IS NOT NULL")
    distinct = good.groupBy("h0", "h1").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    distinct = saved(distinct, "distinct")
    bits, tables = table_plan(distinct.count(), threshold)
    marked = saved(with_signatures(distinct.select("id", "copies", "vector"), bits, tables), "marked")
    left = candidates(block_tasks(marked.select("id", "width", "marks", "signs")), bits, tables, threshold)
    whole = left.join(marked.select("id", "copies", "vector", "signs"), "id")
    found = saved(found_links(whole.select(*TASK, "first", "id", "copies", "vector", "signs"), bits, threshold), "found")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    known = (
        distinct.select("h0", "h1", "id", "copies")
        .join(counts, F.col("id") == F.col("a"), "left")
        .join(parts, F.col("id") == F.col("node"), "left")
        .select(
            F.col("h0").alias("_h0"),
            F.col("h1").alias("_h1"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("part"),
        )
    )
    same = (F.col("h0") == F.col("_h0")) & (F.col("h1") == F.col("_h1")) & F.col("vector").isNotNull()
    out = rows.join(known, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("part", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

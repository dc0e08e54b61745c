"""Near-duplicate documents by SimHash: fingerprints that differ in few bits.

The search covers the fingerprint space with anchor points. The 64 bits are cut into
six blocks; the six triples of blocks in ``TRIPLES`` are chosen so that wherever four
differing bits fall, at least one triple holds one of them or none (the tests try all
ways). On the bits of a triple, the anchors are the words of a covering code: a Hamming
code on the first 31 bits, times all words on the rest. Its covering radius is one, so
every fingerprint lies within one bit of an anchor; two fingerprints that differ in one
bit of the triple at most are both within one plus one bits of that anchor. So each
fingerprint is sent to all anchors within two bits, at most 17 of them, and fingerprints
are compared, over all 64 bits, at each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import given, if_small, row_hashes, saved
from daybook.llm.graph import connected_components

SEED = 42
MAX_BITS = 4
"""What ``TRIPLES`` are made for; smaller distances are found with them too."""
BLOCKS = [range(0, 11), range(11, 22), range(22, 33), range(33, 44), range(44, 54), range(54, 64)]
TRIPLES = [(0, 1, 2), (0, 1, 3), (0, 4, 5), (1, 4, 5), (2, 3, 4), (2, 3, 5)]
CODE_BITS = 31
HASHES_AT_ONCE = 1 << 18


# --- fingerprints -------------------------------------------------------------


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of a text's word shingles; 0 if it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1], ends[width - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), HASHES_AT_ONCE):
        spans = zip(
            first[at : at + HASHES_AT_ONCE].tolist(),
            last[at : at + HASHES_AT_ONCE].tolist(),
            strict=True,
        )
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, (joined[a:b] for a, b in spans), repeat(SEED)), "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * counts > len(first), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(documents: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """``documents`` with the long ``fp`` in place of their text.

    Words are runs of anything but ASCII white space, A-Z in lower case. The whole text
    counts, repeated shingles as often as they occur; fewer words than ``shingle`` make one
    shingle; a text that is null or has no word gets 0.
    """
    kept = documents.drop(text, "fp")
    names = [*kept.columns, "fp"]
    fields = T.StructType([*kept.schema.fields, T.StructField("fp", T.LongType())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            made = [fingerprint(t.as_py(), shingle) for t in texts]
            columns = [*batch.columns[:-1], pa.array(made, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = documents.select(*kept.columns, F.col(text).cast("string").alias("_of_text"))
    return rows.mapInArrow(stream, fields)


# --- anchors ------------------------------------------------------------------


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def bit_mask(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def flips_by_syndrome(code: list[int], rest: list[int]) -> list[list[int]]:
    """For each syndrome, what to flip to get from a fingerprint to each anchor within two
    bits; the first is the nearest anchor."""
    out = []
    for syndrome in range(CODE_BITS + 1):
        home = [code[syndrome - 1]] if syndrome else []
        flips = [home]
        if len(home) < 2:
            flips += [[*home, b] for b in rest]
        if syndrome:
            flips += [
                [code[i - 1], code[(i ^ syndrome) - 1]]
                for i in range(1, CODE_BITS + 1)
                if i < i ^ syndrome and i ^ syndrome <= CODE_BITS
            ]
        else:
            flips += [[a, b] for k, a in enumerate(rest) for b in rest[k + 1 :]]
        out.append([bit_mask(f) for f in flips])
    return out


def anchors(fp: Column, number: int) -> tuple[Column, Column]:
    """Of one triple: its bits of ``fp``, and the array of flips that lead to anchors."""
    bits = [b for k in TRIPLES[number] for b in BLOCKS[k]]
    code, rest = bits[:CODE_BITS], bits[CODE_BITS:]
    checks = [
        F.bit_count(fp.bitwiseAND(F.lit(bit_mask([code[i - 1] for i in range(1, 32) if i >> j & 1]))))
        .bitwiseAND(F.lit(1))
        * (1 << j)
        for j in range(5)
    ]
    syndrome = reduce(lambda a, b: a + b, checks)
    table = F.lit(flips_by_syndrome(code, rest))
    return fp.bitwiseAND(F.lit(bit_mask(bits))), F.element_at(table, syndrome.cast("int") + 1)


def at_anchors(distinct: DataFrame) -> DataFrame:
    """``(bucket, home, fp)``: every fingerprint at every anchor near it. ``home`` marks the
    nearest one of a triple."""
    parts = []
    for number in range(len(TRIPLES)):
        own, flips = anchors(F.col("fp"), number)
        rows = distinct.select("fp", own.alias("own"), F.posexplode(flips).alias("nth", "flip"))
        bucket = F.xxhash64(F.lit(number), F.col("own").bitwiseXOR(F.col("flip")))
        parts.append(rows.select(bucket.alias("bucket"), (F.col("nth") == 0).alias("home"), "fp"))
    return reduce(DataFrame.union, parts)


# --- comparison ---------------------------------------------------------------


def links_within(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of at most ``most`` differing bits connect, one fewer
    than members of each connected part.

    From one member on, those not reached yet are compared with each one reached: where many
    are near each other, few comparisons are made, and no list of pairs.
    """
    if len(fps) == 2:
        near = np.bitwise_count(fps[0] ^ fps[1]) <= most
        return (fps[:1], fps[1:]) if near else (fps[:0], fps[:0])
    left, a, b = fps, [], []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(left ^ at) <= most
            reached = left[near]
            if len(reached):
                a.append(np.full(len(reached), at))
                b.append(reached)
                todo.extend(reached)
                left = left[~near]
    none = fps[:0]
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def bucket_links(buckets: np.ndarray, homes: np.ndarray, fps: np.ndarray, most: int) -> pa.Table:
    """The links of whole buckets, sorted by bucket."""
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else []
    ends = np.r_[starts[1:], len(buckets)]
    found = [(fps[:0], fps[:0])]
    if len(starts):
        with_home = np.add.reduceat(homes.astype(np.int32), starts) > 0
        for k in np.flatnonzero((ends - starts > 1) & with_home):
            found.append(links_within(fps[starts[k] : ends[k]], most))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.table({"a": pairs[:, 0].view("i8"), "b": pairs[:, 1].view("i8")})


def near_links(distinct: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all of the distinct ``fp`` that differ in at most
    ``most`` bits, directly or through others."""
    if not 0 <= most <= MAX_BITS:
        raise ValueError(f"the anchors find distances from 0 to {MAX_BITS}")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            """Compares all buckets that are complete; the last may go on in the next batch."""
            nonlocal held, size
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            keys = columns[0]
            cut = len(keys) if whole else int(np.searchsorted(keys, keys[-1]))
            yield from bucket_links(*[c[:cut] for c in columns], most).to_batches()
            held = [tuple(c[cut:] for c in columns)]
            size = len(keys) - cut

        limit = 1 << 18
        for batch in batches:
            held.append(
                (
                    batch.column(0).to_numpy(),
                    batch.column(1).to_numpy(zero_copy_only=False),
                    batch.column(2).to_numpy().view("u8"),
                )
            )
            size += batch.num_rows
            if size >= limit:
                yield from flush(False)
                limit = max(1 << 18, 2 * size)
        if held:
            yield from flush(True)

    rows = at_anchors(distinct).repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(stream, "a long, b long").where("a <> b").distinct()


def simhash_groups(
    documents: DataFrame, shingle: int = 4, most: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, fingerprint, component_id)`` per row of ``documents``.

    ``component_id`` is the smallest key reachable over links of at most ``most`` differing
    bits. Rows with equal fingerprints meet in one fingerprint before any search, so copies
    cost one row. A null key is kept and never the smallest; a component of null keys only
    has a null id. Other columns play no part.
    """
    narrow = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    marked = saved(fingerprints(narrow, shingle, "_text"), "fingerprints")
    distinct = saved(marked.groupBy("fp").agg(F.min("_key").alias("first")), "distinct")
    parts = connected_components(near_links(distinct.select("fp"), most))
    of = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("part")
    )
    of = saved(of, "parts")
    ids = of.groupBy("part").agg(F.min("first").alias("component_id"))
    ids = of.join(ids, "part").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(ids, marked["fp"] == ids["_fp"]).select(
        F.col("_key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    documents: DataFrame, shingle: int = 4, most: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``documents`` with one row of each group: that of the smallest key, null before others,
    and of rows that share a key but not their content, one chosen by a hash."""
    first, second = row_hashes(documents)
    name = F.struct(F.col(key).alias("key"), first.alias("a"), second.alias("b"))
    rows = given(documents, row=name, words=F.col(text))
    groups = simhash_groups(rows.select("row", "words"), shingle, most, "row", "words")
    marks = groups.groupBy(F.col("row").alias("of")).agg(
        F.count("*").alias("n"), F.first("component_id").alias("component_id")
    )
    # most rows stay as they are: only the others are looked up
    odd = marks.select("of", "n", (F.col("of") == F.col("component_id")).alias("stays"))
    odd = saved(odd.where("NOT stays OR n > 1"), "odd")
    rows, same = rows.select("given", "row"), F.col("row") == F.col("of")
    out = rows.join(if_small(odd), same, "left_anti")
    alike = odd.where("stays")
    if alike.limit(1).count():
        out = out.union(rows.join(if_small(alike), same, "left_semi").dropDuplicates(["row"]))
    return out.select("given.*")

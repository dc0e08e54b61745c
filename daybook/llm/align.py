"""Which tokens of one tokenizer stand for which of another.

Tokens are compared as the bytes they stand for. The places where tokens of both end cut a
text into groups; all tokens of either side in a group are linked. How many documents hold a
pair of ids linked tells, over a corpus, which id of B answers to an id of A.

Equal texts are tokenised and aligned once: texts are grouped by their whole text, each
different one gives the pairs it links, counted as often as the text occurs, and what is
measured on it goes back to the documents by a 128-bit hash of the text. Within a task, units
that no token of either tokenizer reaches across (see ``units``) are aligned once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import given, if_small, saved
from daybook.llm.units import UnitIds, cut_units, gathered, loaded_once, slices

KEY = ["k0", "k1"]
BROADCAST_PAIRS = 2_000_000
"""Pairs of ids, three numbers each, that are broadcast at most; more are joined by a shuffle."""
ROWS_AT_ONCE = 512
BYTES_AT_ONCE = 1 << 20
"""Texts that are aligned together, which takes some hundred bytes for each of theirs."""
LARGE_GROUP = 4096
"""Links of a group from which on its tokens are counted before they meet."""
MARK = "▁"
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes that print as themselves, and the others, in order,
    as the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, a: str, b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[number] = bytes(letters[c] for c in entry)
        self.b = SentencePieceProcessor(model_file=b)
        self.b_bytes = [self.piece_bytes(k) for k in range(self.b.get_piece_size())]
        if any(MARK in self.b.id_to_piece(k).lstrip(MARK) for k in range(self.b.get_piece_size())):
            raise ValueError(f"{b} has pieces that reach across words")
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.names = pa.array([str(k) for k in range(max(len(self.a_bytes), len(self.b_bytes)))])

    def piece_bytes(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(MARK, " ").encode()

    def ids_of_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)


def given_back(ids: np.ndarray, sizes: np.ndarray, table: list[bytes], units: list[bytes]) -> np.ndarray:
    """Flags the units that are the bytes of their ids, which lie end to end."""
    if b"".join([table[k] for k in ids.tolist()]) == b"".join(units):
        bytes_of = np.array([len(t) for t in table])
        if (np.cumsum(bytes_of[ids])[np.cumsum(sizes) - 1] == np.cumsum([len(u) for u in units])).all():
            return np.ones(len(units), bool)
    edges, ids = np.r_[0, np.cumsum(sizes)].tolist(), ids.tolist()
    return np.array(
        [b"".join([table[k] for k in ids[x:y]]) == u for x, y, u in zip(edges, edges[1:], units, strict=False)], bool
    )


def joined_texts(parts: pa.Array, ends: np.ndarray, between: str) -> pa.Array:
    """Parts put together, those up to each end."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[0, ends], pa.int64()), parts), between)


class Aligned:
    """Units, aligned all at once: tokens, groups and links of each, and the groups as text.

    Units that their tokens do not give back are not ``valid`` and have none of these.
    """

    def __init__(self, units: pa.Array, a: UnitIds, b: UnitIds, pair: Pair):
        whole = [b" " + u for u in units.cast(pa.binary()).to_pylist()]
        sides = []
        self.valid = np.ones(len(units), bool)
        for store, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
            flat, starts, sizes = store.of(units)
            ids = flat[gathered(starts, sizes, np.arange(len(units)))]
            self.valid &= given_back(ids, sizes, table, whole)
            sides.append((flat, starts, sizes, store.bytes))
        kept = np.flatnonzero(self.valid)
        ids, ends, self.sizes, groups = [], [], [], []
        for flat, starts, sizes, bytes_of in sides:
            own = flat[gathered(starts, sizes, kept)]
            ids.append(own)
            ends.append(np.cumsum(bytes_of[own]))
            self.sizes.append(np.where(self.valid, sizes, 0))
        cuts = ends[0][np.isin(ends[0], ends[1], assume_unique=True)]
        upto = [np.searchsorted(e, cuts, "right") for e in ends]
        lengths = [np.diff(np.r_[0, u]) for u in upto]
        unit_of = np.repeat(kept, self.sizes[0][kept])[upto[0] - 1]  # of each group
        self.n_groups = np.bincount(unit_of, minlength=len(units))
        links = lengths[0] * lengths[1]
        self.n_links = np.bincount(unit_of, links, len(units)).astype(np.int64)
        groups = [joined_texts(pair.names.take(pa.array(i)), u, ",") for i, u in zip(ids, upto, strict=True)]
        groups = pc.binary_join_element_wise(*groups, "|")
        self.groups = joined_texts(groups, np.cumsum(self.n_groups), ";")
        # each token of A with each of B, and in large groups each different one
        small = links <= LARGE_GROUP
        starts = [u - n for u, n in zip(upto, lengths, strict=True)]
        group = np.flatnonzero(small)
        first = np.repeat(group, lengths[0][group])
        left = ids[0][gathered(starts[0], lengths[0], group)]
        right = ids[1][gathered(starts[1], lengths[1], first)]
        left = np.repeat(left, lengths[1][first])
        owner = np.repeat(unit_of[first], lengths[1][first])
        times = np.ones(len(left), np.int64)
        for k in np.flatnonzero(~small):
            x, n = np.unique(ids[0][starts[0][k] : upto[0][k]], return_counts=True)
            y, m = np.unique(ids[1][starts[1][k] : upto[1][k]], return_counts=True)
            left, right = np.r_[left, np.repeat(x, len(y))], np.r_[right, np.tile(y, len(x))]
            owner = np.r_[owner, np.full(len(x) * len(y), unit_of[k])]
            times = np.r_[times, np.outer(n, m).ravel()]
        order = np.argsort(owner, kind="stable")
        self.pairs, self.times = left[order].astype(np.int64) << 32 | right[order], times[order]
        self.n_pairs = np.bincount(owner, minlength=len(units))


def text_links(units: Aligned, chosen: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts made of the units ``chosen``: where each text's pairs end, the pairs, and how
    often each is linked in its text."""
    text = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    kinds, number = np.unique(units.pairs, return_inverse=True)
    index = gathered(np.cumsum(units.n_pairs) - units.n_pairs, units.n_pairs, chosen)
    keys = np.repeat(text, units.n_pairs[chosen]) * max(1, len(kinds)) + number[index]
    times = units.times[index]
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    sums = np.add.reduceat(times, first) if len(first) else times
    keys = keys[first]
    upto = np.searchsorted(keys // max(1, len(kinds)), np.arange(len(ends)), "right")
    return upto, kinds[keys % max(1, len(kinds))], sums


def distinct_texts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``(k0, k1, text, copies)``: each different text once, with its hash and how many rows
    have it; null and empty ones are left out. Copies are counted before the shuffle."""
    texts = documents.select(F.col(text).cast("string").alias("text")).where("text <> ''")
    return texts.groupBy("text").agg(F.count("*").alias("copies")).select(*text_key("text"), "text", "copies")


def text_key(text: str) -> list:
    return [F.xxhash64(F.lit(k), F.col(text).cast("string")).alias(name) for k, name in enumerate(KEY)]


def aligned_texts(texts: DataFrame, a: str, b: str) -> DataFrame:
    """``(k0, k1, copies, n_a, n_b, n_groups, n_links, groups, links)`` of ``texts (k0, k1, text,
    copies)``.

    ``groups`` has the ids of A and of B of every group, as ``a1,a2|b1;a3|b2,b3``; ``links``
    each pair of ids once with how often it is linked. Texts that
    either tokenizer does not give back byte by byte, a space ahead, have no tokens.
    """
    kind = "k0 long, k1 long, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    kind += "links array<struct<a: int, b: int, times: long>>"
    link = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = loaded_once(f"{a} {b}", lambda: Pair(a, b))
        stores = [UnitIds(pair.ids_of_a, pair.a_sizes, " "), UnitIds(pair.ids_of_b, pair.b_sizes, "")]
        for batch in batches:
            for low, high in slices(batch.column(2), BYTES_AT_ONCE):
                part = batch.slice(low, high - low)
                words, chosen, ends = cut_units(part.column(2))
                units = Aligned(words, *stores, pair)
                first = np.r_[0, ends[:-1]]
                valid = np.minimum.reduceat(units.valid[chosen], first)
                sums = [
                    np.add.reduceat(n[chosen], first) * valid for n in (*units.sizes, units.n_groups, units.n_links)
                ]
                chosen = chosen[np.repeat(valid, ends - first)]
                ends = np.cumsum((ends - first) * valid)
                groups = joined_texts(units.groups.take(pa.array(chosen)), ends, ";")
                upto, pairs, times = text_links(units, chosen, ends)
                fields = [pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32))]
                fields.append(pa.array(times))
                links = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, upto], pa.int32()), pa.StructArray.from_arrays(fields, fields=list(link))
                )
                columns = [*[part.column(k) for k in (0, 1, 3)], *[pa.array(s.astype(np.int64)) for s in sums]]
                whole = pa.RecordBatch.from_arrays(
                    [*columns, groups, links], [*KEY, "copies", *MEASURES[:4], "groups", "links"]
                )
                for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                    yield whole.slice(at, ROWS_AT_ONCE)

    return texts.select(*KEY, "text", "copies").mapInArrow(stream, kind)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(a, b, docs, best)``: how many documents link a pair of ids, and whether no pair with
    the same id of A is linked in more."""
    links = aligned.select("copies", F.explode(F.arrays_zip("links.a", "links.b")).alias("_link"))
    counts = links.groupBy("_link.a", "_link.b").agg(F.sum("copies").alias("docs"))
    counts = saved(counts, "pairs")
    most = counts.groupBy(F.col("a").alias("_a")).agg(F.max("docs").alias("_most"))
    joined = counts.join(most, F.col("a") == F.col("_a"))
    return joined.select("a", "b", "docs", (F.col("docs") == F.col("_most")).alias("best"))


def alignments(
    documents: DataFrame, a: str, b: str, text: str = "text", digest: str | None = None,
    most: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``documents`` with what the alignment of its text measures: tokens ``n_a`` and ``n_b``,
    ``n_groups``, ``n_links``, links ``n_best`` to an id that is linked with the A id in as many
    documents of the corpus as any, ``count_sum``, the documents of its links' pairs added up
    over the links, and ``groups``.

    ``a`` is the file of a byte-level tokenizer, ``b`` that of a model of pieces; executors find
    them there. ``digest`` is an SQL expression over ``groups`` to keep in its place. Texts that
    are null or empty, or that either side does not give back byte by byte, have no tokens:
    zeros, and empty ``groups``, of which ``digest`` is not taken. Rows that repeat count as
    documents each; very many copies of a text are one row before anything is shuffled. An empty
    table gives none. Other columns are passed on, own ones with these names are replaced.
    """
    found = aligned_texts(distinct_texts(documents, text), a, b)
    kept = F.when(F.col("groups") == "", "").otherwise(F.expr(digest)) if digest else F.col("groups")
    found = saved(found.withColumn("groups", kept), "aligned")
    pairs = saved(pair_counts(found), "counts")
    links = found.select(*KEY, F.explode("links").alias("_link")).select(*KEY, "_link.*")
    sums = links.join(if_small(pairs, most), ["a", "b"]).groupBy(*KEY).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    measured = saved(found.drop("copies", "links").join(saved(sums, "sums"), KEY, "left"), "measured")
    names = [*MEASURES, "groups"]
    rows = given(documents, names, **{f"_{k}": c for k, c in zip(KEY, text_key(text), strict=True)})
    same = [F.col(f"_{k}") == F.col(k) for k in KEY]
    return rows.join(measured, same, "left").select(
        "given.*", *[F.coalesce(c, F.lit(0)).alias(c) for c in MEASURES], F.coalesce("groups", F.lit("")).alias("groups")
    )

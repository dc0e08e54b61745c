"""Stretches of words that repeat themselves: all maximal runs, and texts without the repeats.

A run is a stretch of words with a smallest period ``q``, at least twice as long as it, that no
neighbouring word continues. Two places of a text that agree in ``n`` words, in neither the
word before nor the word after them, are a *maximal pair*. If their distance ``d`` is at most
``n``, the ``n + d`` words from the first place on have the period ``d`` and cannot be extended:
runs are exactly the maximal pairs with ``d <= n`` (of those of one stretch the nearest, as
multiples of a period are periods), so nothing has to be extended.

Maximal pairs are enumerated in the tree of intervals of the LCP array, from the bottom up:
an interval stands for ``n`` words that its suffixes share. It holds its suffixes in lists by
the word to their left; when a child is joined, only suffixes of different lists, at a
distance the lengths allow, meet. There are fewer such pairs than 1.5 times the words.

Arrays are made for many texts at once: suffixes by prefix doubling, neighbours' common words
from the ranks of all doublings. Runs of ``least`` words need pairs that share ``least / 2``, so
suffixes that share fewer with any other of their text get no interval, and intervals whose
suffixes have all the same word to their left hold no pair.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import given
from daybook.llm.units import slices

LEAST = 12
"""Words of the shortest run."""
FACTOR = np.uint64(0x9E3779B97F4A7C15)


# --- words --------------------------------------------------------------------


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and where each text's words end. What
    splits is a space and the characters 9 to 13; a null text has no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    there = pc.not_equal(flat, "")
    text = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    text = text[there.to_numpy(zero_copy_only=False)]
    return flat.filter(there), np.cumsum(np.bincount(text, minlength=len(texts)))


# --- suffixes -----------------------------------------------------------------


def dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def recurring(codes: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Flags positions whose next ``width`` words may occur again in the same text, all that
    do among them; compared by hash, so a few others may be flagged."""
    size = len(codes)
    flags = np.zeros(size, bool)
    if size < width:
        return flags
    text = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    hashes = text[: size - width + 1].astype(np.uint64) * FACTOR
    for k in range(width):
        hashes = (hashes ^ (hashes >> np.uint64(29))) * FACTOR + codes[k : size - width + 1 + k].astype(np.uint64)
    inside = np.flatnonzero(np.arange(len(hashes)) + width <= ends[text[: len(hashes)]])
    hashes = hashes[inside]
    ordered = np.sort(hashes)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        flags[inside[twice[at] == hashes]] = True
    return flags


def suffix_ranks(codes: np.ndarray, text: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two are equal. A text
    ends before any word, and words of different texts differ."""
    size = len(codes)
    rank = dense(text * (int(codes.max()) + 1) + codes)
    levels, width, at = [rank.astype(np.int32)], 1, np.arange(size)
    while int(rank.max()) + 1 < size:
        after = at + width
        second = np.where(after < end, rank[np.minimum(after, size - 1)] + 1, 0)
        rank = dense(rank.astype(np.int64) * (size + 1) + second)
        levels.append(rank.astype(np.int32))
        width *= 2
    return levels


def common_words(levels: list[np.ndarray], end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``a`` and at ``b`` of the same texts share."""
    got = np.zeros(len(a), np.int64)
    last = len(end) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + got, b + got
        there = (x < end[a]) & (y < end[b])
        same = levels[k][np.minimum(x, last)] == levels[k][np.minimum(y, last)]
        got += (there & same) << k
    return got


# --- maximal pairs ------------------------------------------------------------


class Suffixes:
    """The suffixes of an interval: their places in order, all and by the word to their left."""

    __slots__ = ("every", "lists")

    def __init__(self, at: int, left: int):
        self.every, self.lists = [at], {left: [at]}

    def take(self, other: Suffixes) -> None:
        merge(self.every, other.every)
        for left, places in other.lists.items():
            if left in self.lists:
                merge(self.lists[left], places)
            else:
                self.lists[left] = places


def merge(into: list[int], new: list[int]) -> None:
    if len(new) == 1:
        insort(into, new[0])
    else:
        into += new
        into.sort()


def between(places: list[int], at: int, low: int, high: int) -> Iterator[int]:
    """Those at a distance from ``low`` to ``high``."""
    for x in places[bisect_left(places, at - high) : bisect_right(places, at - low)]:
        yield x
    for x in places[bisect_left(places, at + low) : bisect_right(places, at + high)]:
        yield x


def joined(
    a: Suffixes, b: Suffixes, shared: int, least: int, found: list[tuple[int, int, int]]
) -> Suffixes:
    """Both together, after their maximal pairs ``(first place, distance, shared words)``."""
    if len(a.every) < len(b.every):
        a, b = b, a
    low = max(1, least - shared)
    for left, places in b.lists.items():
        for at in places:
            first = bisect_left(a.every, at - shared)
            last = bisect_right(a.every, at + shared, first)
            if last == first:
                continue
            if last - first <= len(a.lists):
                own = a.lists.get(left, ())
                for x in between(a.every[first:last], at, low, shared):
                    k = bisect_left(own, x)
                    if k == len(own) or own[k] != x:
                        found.append((min(x, at), abs(x - at), shared))
            else:
                for other, there in a.lists.items():
                    if other != left:
                        found += [(min(x, at), abs(x - at), shared) for x in between(there, at, low, shared)]
    a.take(b)
    return a


def maximal_pairs(
    places: list[int], lefts: list[int], shared: list[int], least: int
) -> list[tuple[int, int, int]]:
    """Of suffixes in order, with the words that neighbours share: the maximal pairs whose
    distance is at most, and with the distance at least ``least``, the words they share."""
    found: list[tuple[int, int, int]] = []
    open_ones: list[tuple[int, Suffixes]] = []
    for at, left, depth in zip(places, lefts, [*shared, -1], strict=True):
        child = Suffixes(at, left)
        while open_ones and open_ones[-1][0] > depth:
            own, held = open_ones.pop()
            child = joined(held, child, own, least, found)
        if open_ones and open_ones[-1][0] == depth:
            open_ones[-1] = (depth, joined(open_ones[-1][1], child, depth, least, found))
        elif depth >= 0:
            open_ones.append((depth, child))
    return found


def runs_of(codes: np.ndarray, ends: np.ndarray, least: int = LEAST) -> np.ndarray:
    """``(start, length, period)`` of all runs of at least ``least`` words of texts whose words
    lie end to end in ``codes``, in order; starts count over all texts."""
    width = -(-least // 2)
    flags = recurring(codes, ends, width)
    sizes = np.diff(np.r_[0, ends])
    text = np.repeat(np.arange(len(ends)), sizes)
    some = np.zeros(len(ends), bool)
    some[text[flags]] = True
    chosen = np.flatnonzero(some[text])
    if not len(chosen):
        return np.zeros((0, 3), np.int64)
    # the texts with such positions, end to end
    codes, flags, text = codes[chosen], flags[chosen], text[chosen]
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    last = np.r_[first[1:], len(text)]
    end = np.repeat(last, last - first)
    left = np.r_[-1, codes[:-1]]
    left[first] = -1
    levels = suffix_ranks(codes, text, end)
    order = np.empty(len(codes), np.int64)
    order[levels[-1]] = np.arange(len(codes))
    order = order[flags[order]]
    shared = common_words(levels, end, order[:-1], order[1:])
    del levels
    cuts = np.flatnonzero(np.r_[True, shared < width])
    lows = np.minimum.reduceat(left[order], cuts)
    highs = np.maximum.reduceat(left[order], cuts)
    found: list[tuple[int, int, int]] = []
    bounds = np.r_[cuts, len(order)]
    for k in np.flatnonzero(lows != highs):
        part = order[bounds[k] : bounds[k + 1]]
        inner = shared[bounds[k] : bounds[k + 1] - 1]
        found += maximal_pairs(part.tolist(), left[part].tolist(), inner.tolist(), least)
    if not found:
        return np.zeros((0, 3), np.int64)
    at, period, words = np.array(found, np.int64).T
    length = words + period
    best = np.lexsort((period, length, at))
    at, length, period = at[best], length[best], period[best]
    nearest = np.r_[True, (at[1:] != at[:-1]) | (length[1:] != length[:-1])]
    at, length, period = at[nearest], length[nearest], period[nearest]
    by_start = np.lexsort((period, at))
    return np.stack([chosen[at], length, period], 1)[by_start]


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Flags the words that no run holds after its first period."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:-1]) == 0


# --- job ----------------------------------------------------------------------

RUN = "array<struct<start: long, length: long, period: long>>"


def without_runs(documents: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``documents`` with ``runs``, all runs of the words of ``text`` by start, then period, and
    ``collapsed``, the words that no run holds after its first period, joined by one space.

    Words are what spaces and the characters 9 to 13 separate; a run has ``least`` words or
    more. A null, empty or blank text has no words: no runs, and an empty ``collapsed``, never
    null. Each row is looked at by itself, so repeated rows and ids are no matter, an empty
    table gives none, and no rows are moved; the longest text must fit into a task's memory,
    at about 150 bytes a word where it repeats itself. Other columns are passed on; own columns
    named ``runs`` and ``collapsed`` are replaced.
    """
    rows = given(documents, ["runs", "collapsed"], _text=F.col(text).cast("string"))
    whole = rows.schema["given"].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                words, ends = words_of(part.column(1))
                codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                runs = runs_of(codes, ends, least)
                kept = kept_words(len(codes), runs)
                total = np.r_[0, np.cumsum(kept)]
                stays = pa.ListArray.from_arrays(
                    pa.array(total[np.r_[0, ends]], pa.int32()), words.filter(pa.array(kept))
                )
                own = np.searchsorted(ends, runs[:, 0], "right")
                edges = np.searchsorted(own, np.arange(len(ends) + 1))
                starts = runs[:, 0] - np.r_[0, ends][own]
                fields = [pa.array(x) for x in (starts, runs[:, 1], runs[:, 2])]
                listed = pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind.value_type))
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), listed, pc.binary_join(stays, " ")], ["given", "runs", "collapsed"]
                )

    found = rows.mapInArrow(stream, f"given {whole}, runs {RUN}, collapsed string")
    return found.select("given.*", "runs", "collapsed")

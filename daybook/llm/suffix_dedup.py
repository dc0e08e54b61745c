"""Removal of long strings that repeat, byte by byte, within and across documents.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else. All
windows of that length would be as many as bytes, so each window is first named by one
short gram in it, the one with the smallest hash (leftmost of ties). Equal windows have
equal grams at equal offsets, so a window whose gram occurs once is unique, and only the
neighbourhoods of grams that repeat, their *segments*, are looked at again.

Segments of one gram that are equal repeat as a whole. Where those of one gram differ,
which is at the ends of a repeated passage, their suffix array tells which windows are
equal. The array is built by grouping (Baier, 2016): suffixes with the same Lyndon prefix
form a group; groups are processed from the largest down, each time moving up the suffixes
that the pointers to the previous smaller suffix lead to; then every group's order is read
off in one pass from the smallest up. No suffix is renamed and nothing recurs.

Grams with more segments than a task should hold are settled without an array, by a hash
of 128 bits of every single window, which spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import given, saved

LENGTH = 400
SEED = 7
BYTES_AT_ONCE = 1 << 20
MOST_SEGMENTS = 4096
"""Different segments of one gram that a task compares at most."""
SYMBOLS_PER_ARRAY = 1 << 17
"""A suffix array holds the segments of as many grams as fit, or of one."""
BROADCAST_ROWS = 1_000_000
"""Rows of up to three longs that are broadcast at most; more are joined by a shuffle."""
SLICE_BITS = 16
"""Spans that start in the same 64 KiB of a text are joined first."""
BASE = 0x9E3779B97F4A7C15 | 1


# --- suffix array -------------------------------------------------------------


def suffix_array(text: Sequence[int]) -> list[int]:
    """The starts of all suffixes of ``text``, in the order of the suffixes."""
    size = len(text)
    of_symbol: dict[int, list[int]] = {}
    for at, symbol in enumerate(text):
        of_symbol.setdefault(symbol, []).append(at)
    members = [of_symbol[s] for s in sorted(of_symbol)]
    above = [*range(1, len(members)), -1]
    below = list(range(-1, len(members) - 1))
    group = [0] * size
    for number, starts in enumerate(members):
        for at in starts:
            group[at] = number
    smaller = [-1] * size
    seen = bytearray(size)
    number = len(members) - 1
    while number >= 0:
        own = [at for at in members[number] if group[at] == number]
        own.sort()
        pointed: dict[int, int] = {}
        for at in own:
            left = at - 1
            while left >= 0 and seen[left]:
                left = smaller[left]
            smaller[at] = left
            seen[at] = 1
            if left >= 0:
                pointed[left] = pointed.get(left, 0) + 1
        members[number] = own
        by_times: dict[int, list[int]] = {}
        for left, times in pointed.items():
            by_times.setdefault(times, []).append(left)
        # one more pointer into this group is a longer Lyndon prefix, so those go up first
        for times in sorted(by_times, reverse=True):
            moved: dict[int, list[int]] = {}
            for left in by_times[times]:
                moved.setdefault(group[left], []).append(left)
            for old, starts in moved.items():
                new = len(members)
                members.append(starts)
                for at in starts:
                    group[at] = new
                higher = above[old]
                above.append(higher)
                below.append(old)
                above[old] = new
                if higher >= 0:
                    below[higher] = new
        number = below[number]
    room = [0] * len(members)
    number = place = 0
    while number >= 0 and size:
        room[number] = place
        place += len(members[number])
        number = above[number]
    out = [-1] * size
    seen = bytearray(size)
    at, rank = size - 1, 0
    while rank < size or at >= 0:
        while at >= 0 and not seen[at]:
            out[room[group[at]]] = at
            room[group[at]] += 1
            seen[at] = 1
            at = smaller[at]
        if rank == size:
            break
        at = out[rank] - 1
        rank += 1
    return out


# --- grams --------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``BASE`` modulo 2^64, and their inverses."""
    if not _powers or len(_powers[0][0]) < size:
        both = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(max(size, BYTES_AT_ONCE), b, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _powers[:] = [(both[0], both[1])]
    up, down = _powers[0]
    return up[:size], down[:size]


_codes: dict[int, np.ndarray] = {}


def codes(seed: int) -> np.ndarray:
    """A random number for each byte."""
    if seed not in _codes:
        _codes[seed] = np.random.default_rng([SEED, seed]).integers(0, 1 << 64, 256, np.uint64)
    return _codes[seed]


class Hashes:
    """64-bit hashes of any parts of ``data``, by running sums."""

    def __init__(self, data: np.ndarray, seed: int):
        code = codes(seed)
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.add.accumulate(code[data] * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def rolling(self, width: int) -> np.ndarray:
        """Of the ``width`` bytes from each position on."""
        size = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:size]) * self.down[:size])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` numbers from each position on."""
    size = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:size], ahead[width - 1 : width - 1 + size])


def segments(data: np.ndarray, ends: np.ndarray, length: int) -> list[np.ndarray]:
    """Of the texts that lie end to end in ``data``, the segments: number of the text, hash of
    the gram, first and last window in the text, place of the gram from the first window on,
    and two hashes of the segment's bytes."""
    starts = np.r_[0, ends[:-1]]
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return [none] * 7
    grams = Hashes(data, 0).rolling(length // 2)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(ranked, length - length // 2 + 1)
    text = np.repeat(np.arange(len(ends)), ends - starts)[: len(least)]
    windows = np.flatnonzero(np.arange(len(least)) + length <= ends[text])
    if not len(windows):
        return [none] * 7
    at = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    low, high, at = windows[first], windows[np.r_[first[1:], len(at)] - 1], at[first]
    marks = [Hashes(data, k).of(low, high + length).view(np.int64) for k in (1, 2)]
    text = text[low]
    place = starts[text]
    return [text, grams[at].view(np.int64), low - place, high - place, at - low, *marks]


def in_pieces(texts: list[bytes], most: int = BYTES_AT_ONCE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts end to end, some at a time: the number of the first, their bytes, their ends."""
    first, held, size = 0, [], 0
    for number, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= most or number == len(texts) - 1:
            yield first, np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(t) for t in held])
            first, held, size = number + 1, [], 0


# --- segments of one gram -----------------------------------------------------


def shared(rows: list[bytes]) -> list[int]:
    """For each row the longest beginning that it shares with any other."""
    out = [0] * len(rows)
    order = sorted(range(len(rows)), key=rows.__getitem__)
    for a, b in zip(order, order[1:], strict=False):
        x, y = rows[a], rows[b]
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            n = int((np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n)).argmax())
        out[a], out[b] = max(out[a], n), max(out[b], n)
    return out


class Block:
    """Segments whose repeated windows one suffix array tells.

    The gram, which all segments of a class have in common, is one symbol of the array. Bytes
    on either side that a segment shares with no other cannot be in a repeated window, so
    they are left out, and so are segments that share too little. Windows are equal if they
    are next to each other in the array and agree in 128 bits of hash.
    """

    def __init__(self, length: int):
        self.length, self.width = length, length // 2
        self.symbols: list[int] = []
        self.parts: list[bytes] = []
        self.kept: list[tuple[object, int, int, int]] = []
        self.classes = 0

    def add(self, rows: list[tuple[object, int, bytes]]) -> None:
        """A class: of each different segment a name, the gram's place and the bytes."""
        width = self.width
        left = shared([text[:gram][::-1] for _, gram, text in rows])
        right = shared([text[gram + width :] for _, gram, text in rows])
        self.classes += 1
        for (name, gram, text), a, b in zip(rows, left, right, strict=True):
            windows = a + b + width - self.length + 1
            if windows > 0:
                self.kept.append((name, gram - a, len(self.symbols), windows))
                part = text[gram - a : gram + width + b]
                self.parts.append(part)
                self.symbols += [x + 1 for x in part[:a]]
                self.symbols.append(256 + self.classes)
                self.symbols += [x + 1 for x in part[a + width :]]
                self.symbols.append(0)

    def repeated(self) -> Iterator[tuple[object, int, int]]:
        """Runs of repeated windows: the segment's name, the first window and the last."""
        if not self.kept:
            return
        _, cut, starts, windows = (np.array(x) for x in zip(*[(0, *k[1:]) for k in self.kept], strict=True))
        segment = np.repeat(np.arange(len(windows)), windows)
        offset = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
        ends = np.cumsum([len(p) for p in self.parts])
        place = np.r_[0, ends[:-1]][segment] + offset
        data = np.frombuffer(b"".join(self.parts), np.uint8)
        marks = [Hashes(data, k).of(place, place + self.length) for k in (3, 4)]
        # no window starts right of the gram, so each starts at a symbol of its own
        window_at = np.full(len(self.symbols), -1)
        window_at[starts[segment] + offset] = np.arange(len(segment))
        order = window_at[np.array(suffix_array(self.symbols))]
        order = order[order >= 0]
        a, b = order[:-1], order[1:]
        same = (marks[0][a] == marks[0][b]) & (marks[1][a] == marks[1][b])
        flags = np.zeros(len(segment), bool)
        flags[a[same]] = flags[b[same]] = True
        at = np.flatnonzero(flags)
        if len(at):
            breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(segment[at]) != 0))
            for first, last in zip(at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]], strict=True):
                k = segment[first]
                yield self.kept[k][0], int(cut[k] + offset[first]), int(cut[k] + offset[last])


# --- jobs ---------------------------------------------------------------------

KEY = ["k0", "k1"]
MARK = ["h", "s0", "s1"]


def keyed(documents: DataFrame, text: str) -> DataFrame:
    """Texts as bytes, null as none, with a 128-bit hash of each."""
    rows = documents.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    return rows.select(
        *[F.xxhash64(F.lit(k), "_t").alias(name) for k, name in enumerate(KEY)],
        F.col("_t").cast("binary").alias("bytes"),
    )


def all_segments(rows: DataFrame, length: int) -> DataFrame:
    """``(k0, k1, h, low, high, gram, s0, s1)``, a row per segment of every row."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in (0, 1)]
            for first, data, ends in in_pieces(batch.column(2).to_pylist()):
                text, h, low, high, gram, s0, s1 = segments(data, ends, length)
                columns = [*[k[first + text] for k in keys], h, low, high, gram, s0, s1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = [*KEY, "h", "low", "high", "gram", "s0", "s1"]
    return rows.mapInArrow(stream, ", ".join(f"{n} long" for n in names))


def small(rows: DataFrame) -> DataFrame:
    """``rows``, a saved table of a few longs, marked for broadcast if it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per text of ``wanted``, a saved table with keys, with its bytes and its columns."""
    keys = saved(wanted.select(*KEY), "keys")
    few = rows.join(small(keys), KEY, "left_semi").groupBy(*KEY).agg(F.first("bytes").alias("bytes"))
    return few.join(wanted, KEY)


def segment_bytes(rows: DataFrame, length: int) -> DataFrame:
    """``(h, s0, s1, n, k0, k1, low, gram, bytes)`` from texts with an array of segments."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for k0, k1, text, found in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for f in found:
                    part = text[f["low"] : f["high"] + length]
                    out.append((f["h"], f["s0"], f["s1"], f["n"], k0, k1, f["low"], f["gram"], part))
                    held += len(part)
                    if held > BYTES_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    names = [*MARK, "n", *KEY, "low", "gram", "bytes"]
    kinds = [f"{n} long" for n in names[:-1]] + ["bytes binary"]
    return rows.select(*KEY, "bytes", "found").mapInArrow(stream, ", ".join(kinds))


def repeats_by_array(parts: DataFrame, length: int, symbols: int) -> DataFrame:
    """``(k0, k1, low, high)``: repeated bytes of the segments that occur once."""

    def spans(block: Block) -> pa.RecordBatch:
        found = [
            (k0, k1, low + first, low + last + length)
            for (n, k0, k1, low), first, last in block.repeated()
            if n == 1
        ]
        columns = zip(*found, strict=True) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [*KEY, "low", "high"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at, held = Block(length), None, {}
        for batch in batches:
            for h, s0, s1, n, k0, k1, low, gram, part in zip(
                *[c.to_pylist() for c in batch.columns], strict=True
            ):
                if h != at:
                    if held:
                        block.add(list(held.values()))
                    if len(block.symbols) >= symbols:
                        yield spans(block)
                        block = Block(length)
                    at, held = h, {}
                held[s0, s1] = ((n, k0, k1, low), gram, part)
        if held:
            block.add(list(held.values()))
        yield spans(block)

    rows = parts.repartition("h").sortWithinPartitions("h")
    return rows.mapInArrow(stream, "k0 long, k1 long, low long, high long")


def repeats_by_window(parts: DataFrame, length: int) -> DataFrame:
    """The same for grams of very many segments, each window by itself."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                rows = batch.slice(s, 256)
                ns, k0, k1, lows = (rows.column(k).to_numpy() for k in (3, 4, 5, 6))
                parts = rows.column(8).to_pylist()
                sizes = np.array([len(p) for p in parts])
                windows = sizes - length + 1
                row = np.repeat(np.arange(len(parts)), windows)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                place = (np.cumsum(sizes) - sizes)[row] + offset
                data = np.frombuffer(b"".join(parts), np.uint8)
                marks = [Hashes(data, k).of(place, place + length).view(np.int64) for k in (3, 4)]
                columns = [*marks, ns[row], k0[row], k1[row], lows[row] + offset]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["w0", "w1", "n", *KEY, "low"]
    windows = saved(parts.mapInArrow(stream, ", ".join(f"{n} long" for n in names)), "windows")
    often = windows.groupBy("w0", "w1").agg(F.sum("n").alias("times")).where("times > 1")
    found = windows.where("n = 1").join(often, ["w0", "w1"], "left_semi")
    return found.select(*KEY, "low", (F.col("low") + length).alias("high"))


def repeated_spans(
    rows: DataFrame, length: int = LENGTH, most: int = MOST_SEGMENTS, symbols: int = SYMBOLS_PER_ARRAY
) -> DataFrame:
    """``(k0, k1, spans)``: for each text with repeated bytes the array of the ``low`` and
    ``high`` of their maximal runs, from ``rows (k0, k1, bytes)``."""
    found = saved(all_segments(rows, length), "segments")
    often = saved(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "grams")
    found = saved(found.join(small(often), "h", "left_semi"), "repeated")
    where = F.struct(*KEY, "low", "high", "gram")
    kinds = saved(found.groupBy(*MARK).agg(F.count("*").alias("n"), F.min(where).alias("first")), "kinds")
    mixed_ones = kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    mixed_ones = saved(mixed_ones.where("kinds > 1 AND least = 1").select("h", "kinds"), "mixed")
    open_ones = kinds.join(mixed_ones, "h").select(*MARK, "n", "kinds", "first.*")
    wanted = open_ones.groupBy(*KEY).agg(
        F.collect_list(F.struct(*MARK, "n", "low", "high", "gram", "kinds")).alias("all")
    )
    wanted = saved(wanted, "wanted")
    texts = texts_of(rows, wanted)
    few = F.filter("all", lambda f: f["kinds"] <= most)
    many = F.filter("all", lambda f: f["kinds"] > most)
    spans = repeats_by_array(segment_bytes(texts.withColumn("found", few), length), length, symbols)
    if mixed_ones.where(F.col("kinds") > most).limit(1).count():
        large = texts_of(rows, saved(wanted.withColumn("found", many).where("size(found) > 0"), "large"))
        spans = spans.union(repeats_by_window(segment_bytes(large, length), length))
    whole = saved(kinds.where("n > 1").select(*MARK), "whole")
    whole = found.join(small(whole), MARK, "left_semi")
    spans = spans.union(whole.select(*KEY, "low", (F.col("high") + length).alias("high")))
    spans = spans.withColumn("_slice", F.shiftright("low", SLICE_BITS))
    whole = merged_spans(merged_spans(spans, [*KEY, "_slice"]).drop("_slice"), KEY)
    return whole.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def merged_spans(spans: DataFrame, by: list[str]) -> DataFrame:
    """Spans of the same ``by`` that touch or overlap joined, by a sort and no array, as a text
    may have a span per byte."""
    order = Window.partitionBy(*by).orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = spans.withColumn("_apart", F.when(F.col("low") <= before, 0).otherwise(1))
    number = F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, 0))
    islands = apart.withColumn("_number", number).groupBy(*by, "_number")
    return islands.agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_number")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def cut_texts(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(k0, k1, runs, kept)``: the texts that lose bytes, each once, what they lose and keep."""
    wanted = saved(repeated_spans(rows, length), "spans")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                cut = merged([(s["low"], s["high"]) for s in spans])
                edges = [0, *[e for run in cut for e in run], len(text)]
                runs.append([{"low": a, "high": b} for a, b in cut])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(runs, kind), pa.array(kept, pa.binary())], [*KEY, "runs", "kept"]
            )

    texts = texts_of(rows, wanted).select(*KEY, "bytes", "spans")
    return texts.mapInArrow(stream, "k0 long, k1 long, runs array<struct<low: long, high: long>>, kept binary")


def without_repeats(documents: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``documents`` with ``kept``, the bytes that stay, and ``runs``, the maximal runs removed.

    A text is its UTF-8 bytes; a null one has none. Strings never reach across documents.
    Rows that repeat are documents of their own, so all of a long repeated text goes. Other
    columns are passed on; own columns named ``kept`` and ``runs`` are replaced.
    """
    rows = keyed(documents, text)
    cut = saved(cut_texts(rows, length), "cut")
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    hashes = {f"h{k}": F.xxhash64(F.lit(k), own) for k in range(len(KEY))}
    out = given(documents, ["kept", "runs"], whole=own.cast("binary"), **hashes)
    out = out.join(cut, (F.col("h0") == F.col("k0")) & (F.col("h1") == F.col("k1")), "left")
    none = F.expr("CAST(array() AS array<struct<low: long, high: long>>)")
    return out.select(
        "given.*", F.coalesce("kept", "whole").alias("kept"), F.coalesce("runs", none).alias("runs")
    )

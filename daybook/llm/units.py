"""Texts cut where no tokenizer of this package joins anything, so that each different piece is
tokenised once.

Byte-level pre-tokenizers put a space at the start of the word that follows it, and pieces with
a word mark begin with it: between a character that is no space and a single space before
another, no token reaches across. Texts are cut there into *units*, without that space. Double
spaces, line ends and the like stay within a unit. The ids of a text are those of its units.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterator
from itertools import repeat
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 8 << 20
"""Texts that are cut together; a longer one by itself."""
REMEMBERED = 1 << 18
"""Units whose ids are kept, give or take a batch; then those that were not met again go, or all
if they are few."""
LONGEST_REMEMBERED = 128
"""Bytes of a unit that is looked up again."""
JOINED = 2048
"""Units that are encoded as one text."""


BLANK = r"[\p{Z}\x09-\x0D\x1C-\x1F\x{85}\x{180E}]"
"""Spaces of any kind, and what older tables call one."""
EDGES = rf"\A\z|\A[\x{{2581}}]|\A{BLANK}|{BLANK}\z|[\x{{2581}}]\z"
"""Units that are not to be joined: empty ones, and those with a space or word mark at an end."""


def cut_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Units of ``texts`` (none of them null), different ones apart from rare repeats; the
    numbers of all units in order; and where each text's units end. An empty text is one empty
    unit."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
    head, tail = (
        pc.match_substring_regex(words, p).to_numpy(zero_copy_only=False)[codes]
        for p in (rf"\A(?:\z|{BLANK})", rf"(?:\A|{BLANK})\z")
    )
    first = np.ones(len(codes), bool)
    first[1:] = ~(tail[:-1] | head[1:])
    first[np.r_[0, ends[:-1]][: len(ends)]] = True
    at = np.flatnonzero(first)
    upto = np.r_[at[1:], len(codes)]
    units = codes[at].astype(np.int64)
    long_ones = np.flatnonzero(upto - at > 1)
    if len(long_ones):
        glued: dict[str, int] = {}
        for k in long_ones:
            text = " ".join(words.take(pa.array(codes[at[k] : upto[k]])).to_pylist())
            units[k] = glued.setdefault(text, len(words) + len(glued))
        words = pa.concat_arrays([words, pa.array(list(glued), words.type)])
    return words, units, np.searchsorted(at, ends)


def loaded_once(key: Hashable, load: Callable[[], object]) -> object:
    """``load()``, once in each Python worker: these functions come anew with each task, but
    modules stay."""
    held = sys.modules.setdefault("_daybook_loaded", ModuleType("_daybook_loaded")).__dict__
    if key not in held:
        held[key] = load()
    return held[key]


class UnitIds:
    """The ids of units, each with a space ahead, one after the other in ``flat``.

    ``encode`` gives the ids of several texts, ``sizes`` the bytes of every id. Many units are
    encoded as one text, as no token reaches across them; where the ids' bytes do not tell the
    units apart, one by one. ``lead`` is what the text of a unit needs before it.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], sizes: np.ndarray, lead: str):
        self.encode, self.bytes, self.lead = encode, sizes, lead
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        self.count = self.total = 0
        self.again = np.zeros(0, bool)

    def forget_rare(self) -> None:
        """Keeps the units that were met again, if they are at most half of what may be kept."""
        kept = [(unit, k) for unit, k in self.known.items() if self.again[k]]
        flat, ends = self.flat[0], self.ends[0]
        self.forget()
        if kept and len(kept) <= REMEMBERED // 2:
            numbers = np.array([k for _, k in kept])
            sizes = np.diff(ends)
            self.known = {unit: k for k, (unit, _) in enumerate(kept)}
            self.flat = [flat[gathered(ends[:-1], sizes, numbers)]]
            self.ends = [np.r_[0, np.cumsum(sizes[numbers])]]
            self.count, self.total = len(kept), len(self.flat[0])
            self.again = np.zeros(self.count, bool)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat, starts, sizes)``: where the ids of each of ``words`` lie."""
        if self.count > REMEMBERED:
            self.forget_rare()
        index = np.fromiter(map(self.known.get, words.to_pylist(), repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(index < 0)
        self.again[index[index >= 0]] = True
        if len(new):
            index[new] = np.arange(self.count, self.count + len(new))
            self.add(words.take(pa.array(new)))
            self.again = np.r_[self.again, np.zeros(len(new), bool)]
        self.flat, self.ends = [np.concatenate(self.flat)], [np.concatenate(self.ends)]
        starts = self.ends[0][index]
        return self.flat[0], starts, self.ends[0][index + 1] - starts

    def add(self, words: pa.Array) -> None:
        """Encodes units and keeps their ids, in order."""
        units, lengths = words.to_pylist(), pc.binary_length(words).to_numpy()
        alone = pc.match_substring_regex(words, EDGES).to_numpy(zero_copy_only=False)
        joinable = np.flatnonzero(~alone)
        alone, parts = np.flatnonzero(alone).tolist(), []
        for at in range(0, len(joinable), JOINED):
            chosen = joinable[at : at + JOINED]
            text = self.lead + " ".join([units[k] for k in chosen.tolist()])
            ids = np.array(self.encode([text])[0], np.int32)
            ends = np.cumsum(lengths[chosen] + 1)
            after = np.cumsum(self.bytes[ids])
            place = np.searchsorted(after, ends)
            if len(ids) and after[-1] == ends[-1] and (after[place] == ends).all():
                parts.append((chosen, ids, np.diff(np.r_[-1, place])))
            else:
                alone += chosen.tolist()
        for at in range(0, len(alone), JOINED):
            chosen = alone[at : at + JOINED]
            found = self.encode([self.lead + units[k] for k in chosen])
            parts.append((np.array(chosen), np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found])))
        order, flat, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        sizes, place = np.zeros(len(units), np.int64), np.empty(len(units), np.int64)
        sizes[order], place[order] = counts, np.cumsum(counts) - counts
        self.flat.append(flat[gathered(place, sizes, np.arange(len(units)))])
        self.ends.append(self.total + np.cumsum(sizes))
        self.known.update(zip(units, range(self.count, self.count + len(units)), strict=True))
        for k in np.flatnonzero(lengths > LONGEST_REMEMBERED).tolist():
            del self.known[units[k]]
        self.count, self.total = self.count + len(units), self.total + len(flat)


def slices(texts: pa.Array, most: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """First row and row after the last of parts of ``texts`` of about ``most`` bytes."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        base = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, base + most, "right")))
        yield first, last
        first = last


def gathered(starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The indexes of the parts ``chosen``, one part after the other."""
    sizes = sizes[chosen]
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts[chosen] - before, sizes) + np.arange(int(sizes.sum()))

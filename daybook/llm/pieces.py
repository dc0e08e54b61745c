"""Texts cut where a byte-level tokenizer with the usual pattern cuts them too, so that each
different piece is encoded once.

The pattern of ``ByteLevel`` takes contractions, then letters, digits or other marks, each with
a space ahead, then white space. A run of letters, digits or marks always ends where the next
character is of another kind, whatever follows, and what follows is looked at by itself; only
white space looks ahead, and ``'`` may take letters along. So a text is cut

* after a letter, digit, mark or other character that is no white space, before a space, tab or
  line end,
* between a letter, a digit and a mark, but not after ``'`` before a letter,
* after one tab or line end between two characters that are no white space.

Kinds are told from bytes for ASCII and the letters of Latin-1; other characters are only known
not to be white space, and those in the blocks where other white space lies (``APART``) are cut
on neither side. Texts with a string of an added token, which is found before the pattern is
applied, are cut before spaces only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daybook.llm.units import LONGEST_REMEMBERED, gathered

BYTES_AT_ONCE = 4 << 20
"""Texts that are cut together; a longer one by itself."""
REMEMBERED = 1 << 19
"""Pieces whose ids are kept from one batch to the next; beyond, those that were not met again
go, or all if half as many were."""
JOINED = 2048
"""Pieces that are encoded as one text."""

APART, SPACE, LINE, LETTER, DIGIT, MARK, QUOTE, OTHER = range(8)
SOLID = [LETTER, DIGIT, MARK, QUOTE, OTHER]


def kinds_of_bytes() -> np.ndarray:
    """The kind of an ASCII character, or what the first byte of a longer one tells."""
    kinds = np.full(256, APART, np.uint8)
    for byte in range(0x21, 0x7F):
        kinds[byte] = LETTER if chr(byte).isalpha() else DIGIT if chr(byte).isdigit() else MARK
    kinds[ord("'")], kinds[ord(" ")] = QUOTE, SPACE
    kinds[[0x09, 0x0A, 0x0D]] = LINE
    # white space beyond ASCII begins with C2, E1, E2 or E3
    kinds[[*range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = OTHER
    return kinds


def cuts_of(finely: bool) -> np.ndarray:
    """Whether to cut between two kinds; ``finely`` also where there is no white space."""
    cuts = np.zeros((8, 8), bool)
    cuts[SOLID, SPACE] = True
    if finely:
        cuts[SOLID, LINE] = True
        for a in (LETTER, DIGIT, MARK, QUOTE):
            cuts[a, [LETTER, DIGIT, MARK, QUOTE]] = True
            cuts[a, a] = False
        cuts[MARK, QUOTE] = cuts[QUOTE, MARK] = cuts[QUOTE, LETTER] = False
    return cuts.reshape(-1)


KINDS, FINE, COARSE = kinds_of_bytes(), cuts_of(True), cuts_of(False)


def kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    kinds = KINDS[data]
    for low, high, more in ((0xC3, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF5, 3)):
        at = np.flatnonzero((data >= low) & (data < high))
        for k in range(1, more + 1):
            kinds[at + k] = kinds[at]
    at = np.flatnonzero(data == 0xC3)
    at = at[(data[at + 1] != 0x97) & (data[at + 1] != 0xB7)]  # signs of times and division
    kinds[at] = kinds[at + 1] = LETTER
    return kinds


def added_strings(tokenizer) -> list[str] | None:
    """The strings of added tokens that are looked for in texts; None if texts are not to be cut,
    as the tokenizer has not the usual pattern or an added token may reach over a space."""
    made = json.loads(tokenizer.to_str())
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    own = {k: (made["pre_tokenizer"] or {}).get(k) for k in usual}
    changed = [made[k] for k in ("normalizer", "truncation", "padding")] + [made["model"].get("dropout")]
    if own != usual or any(changed):
        return None
    special = not tokenizer.encode_special_tokens
    added = [t for t in made["added_tokens"] if special or not t["special"]]
    if any(t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \t\r\n") for t in added):
        return None
    return [t["content"] for t in added]


def cut_pieces(texts: pa.Array, added: list[str] | None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different pieces of ``texts`` (none of them null), the numbers of all pieces in order,
    and where each text's pieces end. An empty text has none. ``added`` are strings that no cut
    may part, with no space in them; if it is None, each text is one piece."""
    edges, data = parts_of(texts)
    first = np.zeros(len(data) + 1, bool)
    if added is not None and len(data):
        kinds = kinds_of(data)
        pairs = kinds[:-1] << 3 | kinds[1:]
        first[1:-1] = FINE[pairs]
        solid = kinds >= LETTER
        at = np.flatnonzero(kinds[1:-1] == LINE) + 1
        first[at[solid[at - 1] & solid[at + 1]] + 1] = True
        if added:
            with_added = pc.match_substring_regex(texts, "|".join(map(re.escape, added)))
            for k in np.flatnonzero(with_added.to_numpy(zero_copy_only=False)).tolist():
                first[edges[k] + 1 : edges[k + 1]] = COARSE[pairs[edges[k] : edges[k + 1] - 1]]
    first[edges] = True
    offsets = np.flatnonzero(first).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(offsets, edges[1:])


def parts_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where texts begin and end, and their bytes end to end."""
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int32), np.zeros(0, np.uint8)
    edges = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return edges - edges[0], data[edges[0] : edges[-1]]


class PieceIds:
    """The ids of pieces, those of the last ones remembered.

    ``encode`` gives the ids of several texts, ``sizes`` the bytes of every id. Many pieces are
    encoded as one text, if ``joined``, where they are cut likewise: those with a space ahead
    follow each other, those without one stand on lines of their own.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], sizes: np.ndarray, joined: bool):
        self.encode, self.bytes, self.joined = encode, sizes, joined
        self.keep(pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool))

    def keep(self, words: pa.Array, flat: np.ndarray, sizes: np.ndarray, again: np.ndarray) -> None:
        self.words, self.flat, self.sizes, self.again = words, flat, sizes, again

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat, starts, sizes)``: where the ids of each of ``words``, all different, lie."""
        index = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        self.again[index[index >= 0]] = True
        new = np.flatnonzero(index < 0)
        index[new] = len(self.words) + np.arange(len(new))
        fresh = words.take(pa.array(new))
        more, counts = self.encoded(fresh)
        flat, sizes = np.concatenate([self.flat, more]), np.concatenate([self.sizes, counts])
        starts = np.cumsum(sizes) - sizes
        again = np.concatenate([self.again, np.zeros(len(new), bool)])
        held = pa.concat_arrays([self.words, fresh])
        fits = pc.binary_length(held).to_numpy() <= LONGEST_REMEMBERED
        if fits.sum() > REMEMBERED:
            fits &= again
            fits &= fits.sum() <= REMEMBERED // 2
            again = np.zeros(len(again), bool)
        if fits.all():
            self.keep(held, flat, sizes, again)
        else:
            chosen = np.flatnonzero(fits)
            self.keep(held.take(pa.array(chosen)), flat[gathered(starts, sizes, chosen)], sizes[chosen], again[chosen])
        return flat, starts[index], sizes[index]

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words``, one after the other, and how many each has."""
        edges, data = parts_of(words)
        spaced = bare = np.zeros(len(words), bool)
        if self.joined and len(words):
            kinds = kinds_of(data)
            lead, last = kinds[edges[:-1]], kinds[edges[1:] - 1] >= LETTER
            after = kinds[np.minimum(edges[:-1] + 1, edges[1:] - 1)]
            spaced, bare = last & (lead == SPACE) & (after >= LETTER), last & (lead >= LETTER)
        alone, parts = np.flatnonzero(~(spaced | bare)).tolist(), []
        for these, line in ((np.flatnonzero(spaced), ""), (np.flatnonzero(bare), "\n")):
            for at in range(0, len(these), JOINED):
                chosen = these[at : at + JOINED]
                text = "".join([w + line for w in words.take(pa.array(chosen)).to_pylist()])
                ids = np.array(self.encode([text])[0], np.int32)
                bytes_of = np.diff(edges)[chosen]
                ends = np.cumsum(bytes_of + len(line))
                ends = np.stack([ends - 1, ends], 1).reshape(-1) if line else ends
                after = np.cumsum(self.bytes[ids])
                place = np.searchsorted(after, ends)
                if not len(ids) or after[-1] != ends[-1] or (after[place] != ends).any():
                    alone += chosen.tolist()
                    continue
                counts = np.diff(np.r_[-1, place])
                if line:
                    starts = np.cumsum(counts) - counts
                    ids = ids[gathered(starts, counts, np.arange(0, len(counts), 2))]
                    counts = counts[::2]
                parts.append((chosen, ids, counts))
        for at in range(0, len(alone), JOINED):
            chosen = np.array(alone[at : at + JOINED])
            found = self.encode(words.take(pa.array(chosen)).to_pylist())
            parts.append((chosen, np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found])))
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        order, flat, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        sizes, place = np.zeros(len(words), np.int64), np.empty(len(words), np.int64)
        sizes[order], place[order] = counts, np.cumsum(counts) - counts
        return flat[gathered(place, sizes, np.arange(len(words)))], sizes

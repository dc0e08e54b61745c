"""Runs of words against a search for every period, and texts of all kinds."""

import random
import re

import numpy as np
import pytest
from llm_words import no_documents, odd  # noqa: F401

from daybook.llm.runs import runs_of, without_runs


def all_runs(words, least):
    """Every stretch of equal distance, kept if its period is the smallest."""
    out = set()
    for p in range(1, len(words) // 2 + 1):
        at = 0
        while at + p < len(words):
            upto = at
            while upto + p < len(words) and words[upto] == words[upto + p]:
                upto += 1
            part = words[at : upto + p]
            if upto > at and len(part) >= max(least, 2 * p):
                if all(part[q:] != part[:-q] for q in range(1, p)):
                    out.add((at, len(part), p))
            at = upto + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(text, least=12):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    runs = all_runs(words, least)
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return runs, " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("seed", range(6))
def test_same_as_every_period(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 4)):
            kinds, size = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 60)
            words = [rng.randrange(kinds) for _ in range(size)]
            if size and rng.random() < 0.5:
                a = rng.randrange(size)
                p = 1 + (size - a) // rng.randint(3, 10)
                words = [words[k] if k < a else words[a + (k - a) % p] for k in range(size)]
            texts.append(words)
        least = rng.choice([12, 7, 4, 2])
        codes = np.array([w for t in texts for w in t], np.int64)
        ends = np.cumsum([len(t) for t in texts])
        base = np.r_[0, ends]
        want = [(s + base[k], n, p) for k, t in enumerate(texts) for s, n, p in all_runs(t, least)]
        assert [tuple(r) for r in runs_of(codes, ends, least)] == want


def test_one_word_many_times_and_many_copies():
    """A third of a million places of one word, and a passage with other words around it each
    time: neither is compared place by place."""
    assert runs_of(np.zeros(300_000, np.int64), np.array([300_000])).tolist() == [[0, 300_000, 1]]
    rng = np.random.default_rng(0)
    line = rng.integers(0, 1000, 9)
    apart = np.concatenate([np.r_[line, rng.integers(10**6, 10**9, 2)] for _ in range(20_000)])
    assert not len(runs_of(apart, np.array([len(apart)])))


TEXTS = [
    None,
    "",
    " \t\n",
    "la " * 30,
    "x " + "a b c " * 5 + "a",
    "\x1ca b " * 20,  # neither splits words
    "a\x0bb\x0cc\r" * 8,
    "one two " * 6 + "one three " + "u v w " * 4,
    "é 雪 🙂 " * 4 + "end",
    " ".join(str(k % 300) for k in range(1200)),
    " ".join(random.Random(3).choice("ab") for _ in range(400)),
]


def test_texts_and_columns(spark):
    """Nulls, blanks, repeated rows, long texts; names that the operator uses itself."""
    rows = [(k, t, "mine", k % 2, "other") for k, t in enumerate([*TEXTS, TEXTS[3], TEXTS[3]])]
    rows.append((None, TEXTS[7], None, None, None))
    given = spark.createDataFrame(rows, "doc_id long, text string, given string, _text int, runs string")
    out = without_runs(given)
    assert out.columns == ["doc_id", "text", "given", "_text", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(rows)
    for row in got:
        runs, text = expected(row["text"])
        assert [tuple(r) for r in row["runs"]] == runs and row["collapsed"] == text
    assert {r["doc_id"]: r["given"] for r in got} == {r[0]: r[2] for r in rows}


def test_empty_table(spark, no_documents):
    assert without_runs(no_documents).collect() == []

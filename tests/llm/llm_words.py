"""Words and documents that the tests share."""

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to") for b in ("", "n", "st", "ver", "la", "mo")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents():
    """Nulls, blanks, copies, a very long text, repeated rows and ids."""
    base = prose(1, 120)
    rows = [
        (0, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, base + " tail", "en", "b", 2),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n", "de", None, 3),
        (6, prose(2, 30_000), "en", "c", 9),
        (7, "Äpfel 雪 🙂 été", None, "é", 4),
        (8, prose(3, 60), "de", "b", 5),
        (8, prose(3, 60), "de", "b", 5),
        (9, "...!!! 123", "en", "a", 6),
        (None, prose(4, 80), "de", "a", 7),
        (None, prose(5, 80), "de", "b", 8),
        (10, "one", "en", "b", None),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)

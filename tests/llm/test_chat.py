import random

import pytest
from pyspark.sql import functions as F

from daybook.llm import chat
from daybook.llm.chat import collapsed

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The kept conversations, turn by turn."""
    order = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:2]) + tuple((x is not None, x or "") for x in r[2:])
    convs = {}
    for row in sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], order(r))):
        convs.setdefault(row[0], []).append(row[2:])
    kept = {}
    for key in sorted(convs):
        mine = convs[key]
        longer = any(len(o) > len(mine) and o[: len(mine)] == mine for o in convs.values())
        if not longer and mine not in kept.values():
            kept[key] = mine
    return sorted((k, n, f"<|{role or ''}|>\n{text or ''}<|end|>\n") for k, turns in kept.items() for n, (role, text) in enumerate(turns))


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("place", "h0", "piece", "last")})
    return sorted((r.conv_id, r.place, r.rendered) for r in collapsed(df).collect())


def logged(seed):
    rng = random.Random(seed)
    full = [[("user" if t % 2 == 0 else "bot", f"{k if rng.random() < 0.7 else 0} {t}") for t in range(rng.randrange(1, 9))] for k in range(8)]
    rows = []
    for conv in range(60):
        turns = rng.choice(full)
        turns = turns[: rng.randrange(1, len(turns) + 1)]
        step = rng.choice([1, 10])
        rows += [(conv, t * step, *x) for t, x in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns_per_piece", [1, 3, 4096])
def test_snapshots_go_and_whole_conversations_stay(spark, monkeypatch, turns_per_piece):
    monkeypatch.setattr(chat, "TURNS_PER_PIECE", turns_per_piece)
    rows = logged(turns_per_piece)
    assert got(spark, rows) == plain(rows)


def test_odd_turns(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "bot", None), (2, 0, "user", "a"), (2, 1, "bot", ""), (3, 0, "user", "a"),
        (3, 0, "user", "a"), (None, 0, "user", "a"), (4, None, "user", "a"), (4, 5, None, "b"), (5, 0, None, None),
        (6, 0, "", ""), (7, 0, "user", "b"), (7, 0, "user", "c"), (8, 0, "user", "c"), (8, 0, "user", "b"),
        (9, -7, "user", "x" * 100_000), (9, 10**12, "bot", "y"), (10, 3, "user", "x" * 100_000),
    ]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == []

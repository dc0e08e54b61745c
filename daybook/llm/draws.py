"""Random draws and permutations as SQL expressions, repeatable by their keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ln_factorial(x: str) -> str:
    """``ln(x!)`` by Stirling's series, moved up by seven so that it also holds for small x."""
    z = f"({x} + 8D)"
    product = " * ".join(f"({x} + {i}D)" for i in range(1, 8))
    return (
        f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1D / (12D * {z}) "
        f"- 1D / (360D * power({z}, 3)) + 1D / (1260D * power({z}, 5)) - ln({product}))"
    )


def let(bindings: dict[str, str], body: str) -> str:
    """``body`` in which the names stand for values that are computed once, in this order."""
    for name, value in reversed(bindings.items()):
        body = f"element_at(transform(array({value}), {name} -> {body}), 1)"
    return body


def hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """How many marked ones are among ``drawn`` out of ``total``, for a uniform ``u``.

    By inversion: probabilities are added up from the mode outwards, each from its
    neighbour's by their ratio, until they exceed ``u``. Twelve standard deviations to
    either side are searched; what lies beyond has no probability in double precision.
    """
    ln_p = " ".join(
        f"{sign} {ln_factorial(x)}"
        for sign, x in [
            ("", "k"), ("-", "m"), ("-", "(k - m)"),
            ("+", "(t - k)"), ("-", "(n - m)"), ("-", "(t - k - n + m)"),
            ("-", "t"), ("+", "n"), ("+", "(t - n)"),
        ]
    )
    up = "a.p_up * (k - a.up) * (n - a.up) / ((a.up + 1D) * (t - k - n + a.up + 1D))"
    down = "a.p_down * a.down * (t - k - n + a.down) / ((k - a.down + 1D) * (n - a.down + 1D))"
    step = let(
        {"p1": up, "p2": down, "c1": "a.c + p1", "c2": "c1 + p2"},
        "named_struct('up', a.up + 1D, 'p_up', p1, 'down', a.down - 1D, 'p_down', p2, 'c', c2, "
        "'x', CASE WHEN a.x >= 0D THEN a.x WHEN v < c1 THEN a.up + 1D "
        "WHEN v < c2 THEN a.down - 1D ELSE -1D END)",
    )
    search = (
        "aggregate(sequence(1, w), named_struct('up', m, 'p_up', p, 'down', m, 'p_down', p, "
        f"'c', p, 'x', IF(v < p, m, -1D)), (a, i) -> IF(a.x >= 0D, a, {step}), "
        "a -> IF(a.x >= 0D, a.x, m))"
    )
    sd = "sqrt(n * (k / t) * (1D - k / t) * (t - n) / greatest(t - 1D, 1D))"
    found = let(
        {
            "t": f"CAST({total} AS DOUBLE)",
            "k": f"CAST({marked} AS DOUBLE)",
            "n": f"CAST({drawn} AS DOUBLE)",
            "v": u,
            "m": "least(k, n, greatest(0D, n + k - t, floor((n + 1D) * (k + 1D) / (t + 2D))))",
            "p": f"exp({ln_p})",
            "w": f"CAST(ceil(12D * {sd}) + 20 AS INT)",
        },
        search,
    )
    return f"CASE WHEN {total} = 0 OR {marked} = 0 OR {drawn} = 0 THEN 0L ELSE CAST({found} AS BIGINT) END"


def split_counts(counts: str, drawn: str, seed: str) -> str:
    """The array of how many of each kind are among ``drawn`` ones taken without replacement
    from ``counts`` of each kind: a multivariate hypergeometric draw, kind by kind."""
    u = f"shiftrightunsigned(xxhash64({seed}, size(s.out)), 11) / 9007199254740992D"
    draw = hypergeometric("s.t", "kind", "s.n", u)
    step = let(
        {"x": draw},
        "named_struct('t', s.t - kind, 'n', s.n - x, 'out', array_append(s.out, x))",
    )
    start = (
        f"named_struct('t', aggregate({counts}, 0L, (a, x) -> a + x), 'n', {drawn}, "
        "'out', CAST(array() AS ARRAY<BIGINT>))"
    )
    return f"aggregate({counts}, {start}, (s, kind) -> {step}, s -> s.out)"


def permuted(index: str, size: str, key: str, rounds: int = 16) -> Column:
    """The image of ``index`` from [0, size) under a pseudorandom permutation of that range,
    one for each ``key``: swap-or-not rounds (Hoang, Morris and Rogaway, 2012), each of which
    pairs every index with its mirror image and swaps the pair or not by a hash."""
    mirror = f"pmod(pmod(xxhash64({key}, r), {size}) - x, {size})"
    step = let({"y": mirror}, f"IF(xxhash64({key}, r, greatest(x, y)) < 0, y, x)")
    return F.expr(f"aggregate(sequence(1, {rounds}), {index}, (x, r) -> {step})")

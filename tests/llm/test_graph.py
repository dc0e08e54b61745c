import random

from daybook.llm.graph import connected_components


def components(edges):
    of = {}

    def find(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return {x: find(x) for x in of}


def run(spark, edges):
    rows = connected_components(spark.createDataFrame(edges, "a long, b long"))
    out = {r.node: r.component for r in rows.collect()}
    assert len(out) == rows.count()
    return out


def test_chains_stars_and_random_edges(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    edges = [(a, b) for a, b in edges if a != b]
    rng.shuffle(edges)
    assert run(spark, edges) == components(edges)


def test_no_edges_loops_nulls_and_repeats(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 1), (None, 2), (3, None), (5, 4), (4, 5), (5, 4)]) == {4: 4, 5: 4}

import math

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import embedding
from daybook.llm.embedding import near_vectors, table_plan


def brute(rows, threshold):
    """Links and component by all pairs."""
    ok = [
        k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) for k, v in rows
    ]
    links = [0] * len(rows)
    part = [k for k, _ in rows]
    near = []
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    near.append((i, j))
    for _ in rows:
        for i, j in near:
            part[i] = part[j] = min(part[i], part[j])
    return sorted(((k is None, k or 0), n, (p is None, p or 0)) for (k, _), n, p in zip(rows, links, part, strict=True))


def got(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    out = near_vectors(df, **settings).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, (r.component_id is None, r.component_id or 0)) for r in out)


def vectors(seed, n=120, size=12):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        center = rng.standard_normal(size)
        for _ in range(rng.integers(1, 8)):
            v = np.float32(center + rng.standard_normal(size) * rng.choice([0.0, 0.05, 0.15, 0.3]))
            rows.append((len(rows) * 3 % 1000, [float(x) for x in v]))
    return rows


def test_all_links(spark):
    rows = vectors(1)
    assert got(spark, rows) == brute(rows, 0.95)


def test_blocks_of_large_signatures(spark, monkeypatch):
    monkeypatch.setattr(embedding.block_tasks, "__defaults__", (5,))
    rows = [(i, [1.0, float(np.float32(0.001 * i)), 0.0]) for i in range(60)] + vectors(2, 30, 3)[:0]
    assert got(spark, rows) == brute(rows, 0.95)


def test_a_length_that_only_one_of_two_blocks_has(spark, monkeypatch):
    monkeypatch.setattr(embedding.block_tasks, "__defaults__", (5,))
    rows = [(i, [1.0, float(np.float32(0.001 * i)), 0.0]) for i in range(60)]
    # of another length, in the same first signature
    bits, tables = table_plan(len(rows))
    first = lambda v: embedding.signatures(embedding.unit_rows(v), bits, tables)[:, 0]
    some = np.random.default_rng(3).standard_normal((20_000, 4))
    center = some[first(some) == first(np.array([rows[30][1]]))[0]][0]
    rows += [(100 + i, [float(np.float32(x * (1 + 1e-5 * i * k))) for k, x in enumerate(center)]) for i in range(20)]
    assert got(spark, rows) == brute(rows, 0.95)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0]),
        (12, [3e38, 3e38]), (13, [1e-30, 1e-30]), (14, [0.0, -0.0]), (15, [1.0, 0.0, 0.0]),
    ]
    assert got(spark, rows) == brute(rows, 0.95)
    nulls = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (None, None)]
    assert got(spark, nulls) == brute(nulls, 0.95)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_tables_keep_the_miss_low():
    for n in (10, 10_000, 10**9):
        bits, tables = table_plan(n)
        meet = (1 - math.acos(0.95) / math.pi) ** bits
        assert (1 - meet) ** tables <= 1e-4


def test_a_sketch_of_some_tables_only(spark, monkeypatch):
    monkeypatch.setattr(embedding, "SKETCH_BITS", 64)
    monkeypatch.setattr(embedding.block_tasks, "__defaults__", (7,))
    rows = vectors(5, 200, 6) + [(2000 + i, [1.0, float(np.float32(0.01 * i))]) for i in range(40)]
    assert got(spark, rows) == brute(rows, 0.95)


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(7)
    for n in (1_000, 10**6):
        bits, tables = table_plan(n)
        held = min(embedding.SKETCH_BITS, bits * tables)
        most = embedding.most_differences(held)
        a = rng.standard_normal((4_000, 40))
        b = rng.standard_normal((4_000, 40))
        a, b = embedding.unit_rows(a), embedding.unit_rows(b)
        b = embedding.unit_rows(b - np.einsum("ij,ij->i", a, b)[:, None] * a)
        near = 0.95 * a + math.sqrt(1 - 0.95**2) * b
        signs = [v @ embedding.directions(40, bits, tables)[:, :held] > 0 for v in (a, near, b)]
        assert (signs[0] != signs[1]).sum(axis=1).max() <= most
        assert np.median((signs[0] != signs[2]).sum(axis=1)) > 1.3 * most


def test_signs_are_the_signatures(spark):
    rows = [(i, 1, [float(x) for x in np.random.default_rng(i).standard_normal(5)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, copies long, vector array<double>")
    got_rows = embedding.with_signatures(df, 9, 11).collect()
    signs = np.frombuffer(b"".join(r.signs for r in got_rows), np.uint8).reshape(20, -1)
    assert signs.shape[1] % 8 == 0
    assert embedding.marks_of(signs, 9, 11).tolist() == [r.marks for r in got_rows]
    assert embedding.marks_of(signs, 9, 0).shape == (20, 0)

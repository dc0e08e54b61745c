import itertools
import random

import numpy as np
import pytest
import xxhash
from llm_words import no_documents, odd  # noqa: F401
from pyspark.sql import functions as F

from daybook.llm import simhash
from daybook.llm.simhash import BLOCKS, TRIPLES, links_within, near_links, one_of_each, simhash_groups


def plain_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(fps, most):
    """Key to the smallest key reachable; ``fps`` are pairs of key and fingerprint."""
    out = {k: k for k, _ in fps}
    changed = True
    while changed:
        changed = False
        for (a, x), (b, y) in itertools.combinations(fps, 2):
            if (x ^ y).bit_count() <= most and out[a] != out[b]:
                out[a] = out[b] = min(out[a], out[b])
                changed = True
    return out


def test_some_triple_holds_at_most_one_of_four_differing_bits():
    assert sorted(b for block in BLOCKS for b in block) == list(range(64))
    for blocks in itertools.combinations_with_replacement(range(6), 4):
        assert any(sum(b in t for b in blocks) <= 1 for t in TRIPLES)


@pytest.mark.parametrize("number", range(len(TRIPLES)))
def test_fingerprints_one_bit_apart_meet_at_the_nearest_anchor_of_each(number):
    bits = [b for k in TRIPLES[number] for b in BLOCKS[k]]
    code, rest = bits[:31], bits[31:]
    table = simhash.flips_by_syndrome(code, rest)
    checks = [[code[i - 1] for i in range(1, 32) if i >> j & 1] for j in range(5)]
    held = sum(1 << b for b in bits)

    def reached(fp):
        syndrome = sum((sum(fp >> b & 1 for b in c) & 1) << j for j, c in enumerate(checks))
        return [(fp & held) ^ (f % (1 << 64)) for f in table[syndrome]]

    rng = random.Random(number)
    for _ in range(20):
        fp = rng.getrandbits(64)
        for bit in [None, *bits]:
            other = fp if bit is None else fp ^ (1 << bit)
            assert reached(fp)[0] in reached(other)


def test_links_connect_what_pairs_connect():
    rng = random.Random(3)
    for _ in range(30):
        center = rng.getrandbits(64)
        fps = list({center ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) % (1 << 64) for _ in range(25)})
        a, b = links_within(np.array(fps, np.uint64), 4)
        linked = [(int(x), int(y)) for x, y in zip(a, b, strict=True)]
        assert all((x ^ y).bit_count() <= 4 for x, y in linked)
        wanted = least_reachable([(f, f) for f in fps], 4)
        assert len(linked) == len(fps) - len(set(wanted.values()))


def test_all_links_of_random_neighbours(spark):
    rng = random.Random(11)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(rng.randrange(4)):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])))
            fps.add(f)
    rows = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in near_links(rows).collect()]
    got = {f: f for f in fps}
    for _ in fps:
        for a, b in links:
            got[a] = got[b] = min(got[a], got[b])
    assert got == least_reachable([(f, f) for f in fps], 4)


def test_odd_documents(odd):
    rows = odd.withColumn("fp", F.lit("x")).withColumn("component", F.lit(1)).withColumn("_key", F.lit(2))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash_groups(rows).collect())
    source = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    keys = [(k is None, k or 0, n) for n, (k, _) in enumerate(source)]
    reach = least_reachable([(k, f) for k, (_, f) in zip(keys, source, strict=True)], 4)
    wanted = sorted(
        (k[0], k[1], format(f, "016x"), None if reach[k][0] else reach[k][1]) for k, (_, f) in zip(keys, source, strict=True)
    )
    assert got == wanted


def test_one_row_of_each_group_stays(odd):
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    groups = {(r.doc_id, r.text) for r in rows}
    assert len(groups) == len(rows)
    fps = [plain_fingerprint(r.text) for r in odd.collect()]
    assert len(rows) == len(set(least_reachable(list(enumerate(fps)), 4).values()))


def test_empty_table(no_documents):
    assert simhash_groups(no_documents).collect() == []
    assert one_of_each(no_documents).collect() == []


def test_distances_beyond_the_anchors_are_refused(odd):
    with pytest.raises(ValueError, match="4"):
        simhash_groups(odd, most=5)

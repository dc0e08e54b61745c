import re
from collections import Counter

from llm_words import no_documents, odd  # noqa: F401
from pyspark.sql import functions as F

from daybook.llm import mix
from daybook.llm.common import row_hashes
from daybook.llm.mix import mixed, mixed_blocks, mixed_documents, packed, slots, source_targets


def filled(sizes, weights=(5.0, 2.0, 1.0), passes=3):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = {}
    left, open_ones = float(sum(sizes.values())), list(names)
    while open_ones:
        level = left / sum(weight[s] for s in open_ones)
        full = [s for s in open_ones if level * weight[s] > passes * sizes[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_ones}
            break
        for s in full:
            target[s] = float(passes * sizes[s])
            left -= target[s]
            open_ones.remove(s)
    return target


def test_targets(spark):
    for sizes in (
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 1000, "c": 20, "d": 3, None: 500},
        {"a": 0, "b": 50, "é": 7, "z": 1, "Z": 900},
        {"a": 5},
        {"a": 0, None: 0},
    ):
        rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in source_targets(rows).collect()}
        wanted = filled(sizes)
        assert got.keys() == wanted.keys()
        assert all(abs(got[s] - wanted[s]) < 1e-6 * (1 + wanted[s]) for s in got), (got, wanted)


def corpus(spark):
    rows = [(i, " ".join("w" * (1 + i % 3) for _ in range(i % 50)), "abcdefg"[min(6, i % 11)]) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_come_near_their_targets_and_documents_stay_within_the_passes(spark):
    rows = corpus(spark).withColumn("size", F.lit("x")).withColumn("start", F.lit(1))
    got = mixed(rows).collect()
    assert len(got) == 600
    by = {}
    for r in got:
        assert r.size == r.doc_id % 50 and 0 <= r.taken <= 3 * r.size and 0 <= r.copies <= 3
        by.setdefault(r.source, []).append(r)
    wanted = filled({s: sum(r.size for r in rs) for s, rs in by.items()})
    for source, rs in by.items():
        assert {r.source_size for r in rs} == {sum(r.size for r in rs)}
        assert abs(rs[0].target - wanted[source]) < 1e-6
        assert abs(sum(r.taken for r in rs) - wanted[source]) < 0.1 * wanted[source] + 150
    again = mixed(rows.repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}


def test_blocks_cover_each_word_once(spark):
    rows = mixed(corpus(spark)).select("doc_id", "source", "size")
    streams = mix.in_streams(
        rows.selectExpr("doc_id", "ascii(source) AS number", "size", "xxhash64(doc_id) AS order")
    )
    pieces = packed(streams, 32).collect()
    total = Counter()
    for p in pieces:
        assert 0 < p.words <= 32
        total[p.number, p.block] += p.words
    for number in {n for n, _ in total}:
        blocks = [total[number, b] for b in range(max(b for n, b in total if n == number) + 1)]
        assert all(b == 32 for b in blocks[:-1])
    assert sum(total.values()) == sum(r.size for r in rows.collect())


def test_slots_take_whole_passes_before_the_next(spark):
    targets = spark.createDataFrame([("a", 0, 3200, 9600.0), ("b", 1, 320, 100.0)], "source string, number int, source_size long, target double")
    got = slots(targets, 32, 8, 1).collect()
    for number, blocks in ((0, 100), (1, 10)):
        by_pass = {}
        for r in got:
            if r.number == number:
                by_pass.setdefault(r["pass"], []).append(r.block)
        for k, taken in by_pass.items():
            assert len(taken) == len(set(taken)) and max(taken) < blocks and k < 3
            assert len(taken) == blocks or k == max(by_pass)
    assert {r.shard for r in got} <= set(range(8))


def test_odd_documents(odd, no_documents):
    got = mixed(odd).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r.size for r in got) == sorted(count(r.text) for r in odd.collect())
    assert all(r.taken <= 3 * r.size for r in got)
    assert {r.source for r in got} == {r.source for r in odd.collect()}
    clashing = odd.withColumn("given", F.lit(1)).withColumn("copies", F.lit(2))
    docs = mixed_documents(clashing)
    assert docs.columns == clashing.columns
    texts = {r.text for r in odd.collect() if count(r.text)}
    assert {r.text for r in docs.collect()} <= texts
    assert mixed(no_documents).collect() == [] and mixed_documents(no_documents).collect() == []
    assert mixed_documents(odd.where("text IS NULL OR text = ''")).collect() == []


def test_documents_come_as_often_as_their_first_word(spark):
    rows = corpus(spark)
    copies = {r.doc_id: r.copies for r in mixed(rows.select("*")).collect()}
    got = Counter(r.doc_id for r in mixed_documents(rows).collect())
    assert sum(got.values()) > 0 and max(got.values()) <= 3
    assert abs(sum(got.values()) - sum(copies.values())) < 0.3 * sum(copies.values())


def test_words_of_each_source_meet_its_target_whole_or_cut(spark):
    long = " \t".join(f"w{k}" for k in range(20_000))
    rows = [(0, " " + long, "a")] + [(i, f"x{i} y z", "a") for i in range(1, 50)]
    rows += [(100 + i, " ".join(f"v{i}_{k}" for k in range(60)), "bc"[i % 2]) for i in range(300)]
    rows += [(1000, "all alike " * 20, "d")] * 200 + [(2000, None, "d"), (2001, " ", "a")]
    words = lambda t: len((t or "").split())
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("m", F.expr("map(1, 2)"))
    for weights in ((5.0, 2.0, 1.0), (1.0, 2.0, 5.0), (2.0, 1.0, 1.0)):
        wanted = filled(sizes, weights)
        got = mixed_documents(documents, weights).collect()
        taken, copies = Counter(), Counter()
        for r in got:
            taken[r.source] += words(r.text)
            copies[r.doc_id] += 1
            whole = next(t for k, t, _ in rows if k == r.doc_id)
            assert whole.startswith(r.text) and (r.text == whole or r.source == "a" and words(r.text) < 20_000)
        for source, target in wanted.items():
            assert abs(taken[source] - target) <= max(128, 0.05 * target), (weights, source, taken, wanted)
        assert max(n for k, n in copies.items() if k != 1000) <= 3
        assert 2000 not in copies and 2001 not in copies


def test_blocks_hold_the_words_that_are_taken(spark):
    rows = corpus(spark).union(corpus(spark).where("doc_id < 20"))
    pieces = mixed_blocks(rows, shards=4).collect()
    texts = {r.doc_id: r.text.split() for r in rows.collect()}
    blocks = {}
    for p in pieces:
        assert p.text.split(" ") == texts[p.doc_id][p.first : p.first + p.words] and p.words > 0
        blocks.setdefault((p.shard, p.slot), []).append(p)
    total, short = Counter(), Counter()
    for block in blocks.values():
        assert len({p.source for p in block}) == 1
        short[block[0].source] += sum(p.words for p in block) != 32
        for p in block:
            total[p.source] += p.words
        # pieces follow each other: all but the first start with their document
        block.sort(key=lambda p: p.start)
        assert all(p.first == 0 for p in block[1:])
    assert max(short.values()) <= 3 and len({s for s, _ in blocks}) == 4
    sizes = Counter()
    for r in rows.collect():
        sizes[r.source] += len(texts[r.doc_id])
    for source, target in filled(sizes).items():
        assert abs(total[source] - target) < 0.1 * target + 150


def test_documents_are_those_whose_blocks_are_drawn(spark):
    """Undrawn documents do not come, full ones come whole, others by their words or evened out."""
    rows = [(i, " ".join(f"w{i}" for _ in range(1 + i * 7 % 90)), "abcde"[min(4, i % 9)]) for i in range(900)]
    rows += [(1000 + i, " ".join(f"x{i}_{k}" for k in range(2_500)), "ef"[i % 2]) for i in range(16)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, second = row_hashes(rows)
    key = F.struct(first.alias("a"), second.alias("b"))
    names = {tuple(r.key): r.doc_id for r in rows.select("doc_id", key.alias("key")).collect()}
    drawn = {names[tuple(r.doc_id)]: r for r in mixed(rows.select(key.alias("doc_id"), "source", "text")).collect()}
    docs = mixed_documents(rows)
    whole, cut = Counter(), {}
    for r in docs.collect():
        words = len(r.text.split())
        if words == drawn[r.doc_id].size:
            whole[r.doc_id] += 1
        else:
            assert r.doc_id not in cut
            cut[r.doc_id] = words
    off = Counter()
    for k, r in drawn.items():
        full, rest = divmod(r.taken, r.size)
        assert whole[k] in ((full, full + 1) if rest and k not in cut else (full,)), (k, r, whole[k])
        assert k not in cut or rest and 0 < cut[k] < r.size
        off[r.source] += whole[k] * r.size + cut.get(k, 0) - r.taken
    assert max(Counter(drawn[k].source for k in cut).values()) == 1
    near = {r.source: max(128, 0.05 * r.target) for r in drawn.values()}
    assert all(abs(n) <= near[s] for s, n in off.items()), (off, near)
    assert len(set(whole.values())) > 1 and any(not whole[k] and r.size for k, r in drawn.items())
    again = mixed_documents(rows.repartition(7))
    assert Counter(docs.collect()) == Counter(again.collect())

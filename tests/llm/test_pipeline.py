import re
from collections import Counter

import pytest
from llm_words import prose
from pyspark.sql import functions as F
from test_simhash import least_reachable, plain_fingerprint

import corpus_pipeline
from daybook.llm import common, decontaminate
from daybook.llm.common import saved
from daybook.llm.language import held_out

ENGLISH = "the of and in to that is was for with this from they have were which their would there been".split()


def english(seed, n):
    return " ".join(ENGLISH[(seed * 7 + k * k + k * seed) % len(ENGLISH)] + " " + prose(seed * 1000 + k, 1) for k in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    items = [(0, prose(7001, 30)), (1, prose(7002, 20))]
    rows = [(i, english(i, 40), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(60 + i, prose(i, 60), "xx", f"s{i % 4}", 1) for i in range(40)]
    rows += [(200, rows[3][1], "en", "s0", 1), (201, rows[3][1], "en", "s1", 1), (202, rows[70][1], "xx", "s1", 1)]
    rows += [(300, english(90, 20) + " " + items[0][1], "en", "s0", 1), (301, items[1][1].upper() + " " + english(91, 20), "en", "s1", 1)]
    rows += [(400, None, "en", "s0", 1), (401, "", "en", "s0", 1), (402, "12 34 --", "en", "s1", 1), (None, english(95, 30), None, None, None)]
    rows += [(500, english(96, 30), "en", "s0", 1)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stage_by_stage(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, tables), name)
        seen[name] = (before.collect(), docs.collect())
        assert docs.columns == columns or name == "sharding"
    was, now = seen["language_id"]
    assert Counter(was) - Counter(now) == Counter(r for r in was if not re.search(r"[^\W\d_]", r.text or ""))
    was, now = seen["near_duplicates"]
    groups = least_reachable([(k, plain_fingerprint(r.text)) for k, r in enumerate(was)], 4)
    assert len(now) == len(set(groups.values())) and set(now) <= set(was)
    assert {200, 201, 202}.isdisjoint({r.doc_id for r in now})
    was, now = seen["decontamination"]
    assert {r.doc_id for r in set(was) - set(now)} == {300, 301} and len(was) - len(now) == 2
    was, now = seen["mixing"]
    assert set(now) <= set(was) and max(Counter(now).values()) <= 3
    was, now = seen["sharding"]
    assert Counter(r[:5] for r in now) == Counter(tuple(r) for r in was)
    sizes = Counter(r.shard for r in now)
    assert max(sizes.values()) - min([sizes[s] for s in range(16)]) <= 1
    assert all(sorted(r.slot for r in now if r.shard == s) == list(range(n)) for s, n in sizes.items())
    whole = corpus_pipeline.run(spark, tables)
    assert Counter(whole.collect()) == Counter(now)


def test_the_same_beyond_the_bound_of_a_broadcast(spark, tables, monkeypatch):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    few = {n: Counter(stages[n](spark, docs, tables).collect()) for n in ("near_duplicates", "decontamination", "mixing")}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    for name, rows in few.items():
        assert Counter(stages[name](spark, docs, tables).collect()) == rows


def test_lettered_texts_stay_if_nothing_was_learned(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for unlabelled in (docs.withColumn("lang", F.lit(None).cast("string")), docs.where(held_out())):
        got = Counter(corpus_pipeline.language_id(spark, unlabelled, tables).collect())
        assert got == Counter(r for r in unlabelled.collect() if re.search(r"[^\W\d_]", r.text or "")) and got


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, tables), name)
    assert docs.collect() == []

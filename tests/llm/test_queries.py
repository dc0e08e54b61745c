"""The registered queries on the smallest tables: against SQL where there is some, and the
columns and rows of all."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from daybook.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import connect, difference

SF_DIR = contract.SMOKE_DIR

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")

COLUMNS = {
    "op1_urls": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op2_warc": {
        "page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string",
        "refers_to": "bigint",
    },
    "op3_leaks": {"doc_id": "bigint", "item_id": "bigint", "start": "bigint", "words": "bigint", "matches": "bigint"},
    "op4_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_chat": {"conv_id": "bigint", "place": "bigint", "role": "string", "rendered": "string"},
    "op6_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_repeats": {
        "doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string",
        "text": "string",
    },
    "op8_shards": {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    },
    "op9_vectors": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op10_mix": {
        "doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint",
        "source": "string",
    },
    "op11_runs": {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    },
    "op12_tokens": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op13_align": {
        "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
        "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string",
    },
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES) and {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_result(spark, name):
    assert difference(spark, connect(SF_DIR), name, SF_DIR) == ""


@pytest.mark.parametrize("name", QUERIES)
def test_columns_and_rows(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert dict(frame.dtypes) == COLUMNS[name]
    tables = {"op1": "pages", "op2": "pages", "op9": "embeddings"}
    rows = frame.count()
    if name not in ("op3_leaks", "op5_chat"):
        whole = spark.read.parquet(f"{SF_DIR}/{tables.get(name.split('_')[0], 'documents')}.parquet")
        assert rows == whole.count()
    assert rows > 0

import gzip
import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import warc
from daybook.llm.warc import SCHEMA, WarcReader, page_records, read_warc, record_bytes, records, write_warc


def pages():
    long = "<p>" + "é" * 600 + "</p>"
    return [
        (1, "http://a/1", long), (2, "http://a/2", long), (3, "http://a/3", long), (4, "http://a/4", "short"),
        (5, "http://a/5", "short"), (6, None, None), (7, "http://a/7", ""), (8, "http://a/8\r\nWARC-Type: x", "b" * 1000),
        (9, "http://a/9", "\r\n\r\nWARC/1.1\r\n\r\n" * 400), (None, "http://a/n", long), (10, "u", "c" * 999), (11, "u", "c" * 999),
        (12, "http://a/12", "d" * 300_000), (13, "http://a/13", "d" * 300_000),
    ]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "pages")
    rows = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("_first", F.lit(1))
    write_warc(page_records(rows).repartition(3), path)
    return path


def test_round_trip(spark, archive):
    by_payload = {}
    for key, _, html in pages():
        data = (html or "").encode()
        if len(data) >= 1000:
            by_payload.setdefault(data, []).append(key or -1)
    got = {r.record_id: r for r in read_warc(spark, archive).collect()}
    assert len(got) == len(pages())
    for key, url, html in pages():
        data = (html or "").encode()
        r = got[f"urn:page:{'' if key is None else key}"]
        first = max(by_payload.get(data, [key or -1]))
        assert r.payload_digest == hashlib.sha1(data).hexdigest() and r.payload_length == len(data)
        assert r.target_uri == (" ".join(url.splitlines()) if url else None)
        if (key or -1) == first:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, data)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", f"urn:page:{first}", None)


def test_predicates_on_headers_are_pushed_down(spark, archive):
    rows = read_warc(spark, archive).where("record_type = 'revisit' AND target_uri IN ('http://a/1', 'http://a/13', 'http://a/4')")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert ") Filter " not in plan
    assert {r.target_uri for r in rows.collect()} == {"http://a/1"}
    none = read_warc(spark, archive).where("record_type = 'revisit' AND record_type = 'response'")
    assert none.collect() == []
    assert read_warc(spark, archive).where("target_uri IS NOT NULL").count() == len(pages()) - 1


def test_payloads_that_are_not_asked_for_are_not_decoded(spark, archive, monkeypatch):
    reader = WarcReader(spark.createDataFrame([], "record_id string, record_type string").schema, {"path": archive})
    monkeypatch.setattr(warc.Bytes, "take", lambda *_: pytest.fail("a payload was read"))
    found = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in found) == len(pages())


def test_files_of_failed_tasks_are_not_read(spark, archive, tmp_path):
    before = read_warc(spark, archive).count()
    with gzip.open(f"{archive}/part-left.warc.gz", "wb") as sink:
        sink.write(record_bytes({"record_id": "x", "record_type": "response"}))
    assert read_warc(spark, archive).count() == before
    more = spark.createDataFrame([("urn:more", "response", b"z")], "record_id string, record_type string, payload binary")
    path = str(tmp_path / "own")
    write_warc(more, path)
    write_warc(more, path)
    assert read_warc(spark, path).count() == 2


def test_plain_archives_of_others_and_odd_headers():
    one = (
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\na: b\n\r\n\r\n"
        b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Target-URI: http://x\r\n /y\r\nWARC-Payload-Digest: md5:abc\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    )
    for data in (one, gzip.compress(one), gzip.compress(one[:60]) + gzip.compress(one[60:])):
        found = list(records(pa.BufferReader(data), {}, True, True))
        assert [(r["record_type"], r["payload"]) for r in found] == [("warcinfo", b"a: b\n"), ("resource", b"")]
        assert found[1]["target_uri"] == "http://x /y" and found[1]["payload_digest"] == "md5:abc"
        assert [r["record_type"] for r in records(pa.BufferReader(data), {"record_type": {"resource"}}, False, False)] == ["resource"]
    assert list(records(pa.BufferReader(b""), {}, True, True)) == []


def test_a_cut_archive_is_an_error():
    data = record_bytes({"record_id": "a", "record_type": "response", "payload": b"x" * 1000})
    with pytest.raises(EOFError):
        list(records(pa.BufferReader(data[:700]), {}, True, True))


def http_record(number, block):
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <{number}>\r\nContent-Type: application/http\r\n"
    return head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_an_http_head_ends_in_its_own_record(packed):
    """A head without an end is all payload and takes nothing of the records after it."""
    blocks = [b"HTTP/1.1 200 OK\r\nA: b", b"", b"HTTP/1.1 200 OK\r\n\r\nhello", b"x" * 400_000 + b"\r\n\r", b"HTTP/1.1 200 OK\r\n\r\n"]
    wanted = [blocks[0], b"", b"hello", blocks[3], b""]
    parts = [http_record(k, b) for k, b in enumerate(blocks)]
    data = b"".join(gzip.compress(p) for p in parts) if packed else b"".join(parts)
    found = list(records(pa.BufferReader(data), {}, True, True))
    assert [(r["record_id"], r["payload"], r["payload_length"]) for r in found] == [
        (str(k), w, len(w)) for k, w in enumerate(wanted)
    ]
    assert [r["payload_length"] for r in records(pa.BufferReader(data), {}, False, True)] == [len(w) for w in wanted]
    assert len(list(records(pa.BufferReader(data), {}, False, False))) == len(blocks)


def test_archives_cut_anywhere_are_errors():
    parts = [http_record(k, b"HTTP/1.1 200 OK\r\n\r\n" + bytes([65 + k]) * 3000) for k in range(2)]
    packed = [gzip.compress(p) for p in parts]
    for cut in (30, len(packed[1]) - 9):
        data = packed[0] + packed[1][:cut]
        for payloads in (True, False):
            with pytest.raises(EOFError, match="gzip member|record"):
                list(records(pa.BufferReader(data), {}, payloads, payloads))
    for cut in (10, 200, 2000):
        data = parts[0] + parts[1][:cut]
        for payloads in (True, False):
            with pytest.raises(EOFError, match="inside a record"):
                list(records(pa.BufferReader(data), {}, payloads, payloads))
    close = parts[0].rstrip(b"\r\n") + parts[1].rstrip(b"\r\n")  # no line ends between records
    assert len(list(records(pa.BufferReader(close), {}, True, True))) == 2


def test_empty_tables_and_folders(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    path = str(tmp_path / "none")
    write_warc(page_records(none), path)
    assert read_warc(spark, path, SCHEMA).collect() == []


def test_partitions_follow_the_bytes(tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * 100)
    reader = WarcReader(None, {"path": str(tmp_path), "maxPartitionBytes": "250"})
    assert [len(p.paths) for p in reader.partitions()] == [2, 2, 2]

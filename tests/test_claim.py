"""One writer at a time."""

import os
import threading
import time

import pytest

from daybook import run
from daybook.plans import ConcurrentLoadError, claim, load_files, loads
from daybook.sources import list_files
from daybook.workspace import read_file


def test_two_loads_at_once(spark, shop, monkeypatch):
    """The second load, in a thread and a session of its own, starts while the first writes."""
    spec = shop.spec()
    shop.day("2010-12-01", 3)
    errors, original = [], loads._write

    def other():
        try:
            run(spark.newSession(), spec)
        except ConcurrentLoadError as error:
            errors.append(str(error))

    def write(*given):
        second = threading.Thread(target=other)
        second.start()
        second.join()
        return original(*given)

    with monkeypatch.context() as m:
        m.setattr(loads, "_write", write)
        assert run(spark, spec).rows == 3
    assert len(errors) == 1 and shop.table in errors[0]
    assert shop.counts() == {20101201: 3}
    assert read_file(spark, spec.claim_path) is None
    assert run(spark, spec).status == "already_loaded"


def test_a_failed_load_gives_its_claim_back(spark, shop, monkeypatch):
    spec = shop.spec()
    shop.day("2010-12-01", 1)
    with monkeypatch.context() as m:
        m.setattr(loads, "_write", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, spec)
    assert load_files(spark, spec, list_files(spark, spec.inbound)).rows == 1


def test_a_dead_claim_counts_for_nothing(spark, shop):
    spec, path = shop.spec(), shop.root / "table_claim"
    shop.day("2010-12-01", 1)
    path.write_text("dead")
    with pytest.raises(ConcurrentLoadError, match="dead"):
        run(spark, spec)
    old = time.time() - 700
    os.utime(path, (old, old))
    assert run(spark, spec).rows == 1
    assert not list(shop.root.glob("*claim*"))


def test_a_running_load_keeps_its_claim_young(spark, shop):
    spec, path = shop.spec(claim_minutes=0.01), shop.root / "table_claim"  # 0.6 s, set every 0.15 s
    with claim.claimed(spark, spec):
        for _ in range(3):
            time.sleep(0.5)
            assert time.time() - path.stat().st_mtime < 0.5
        with claim.claimed(spark, spec):  # within the same call
            pass
        assert path.exists()
    assert not path.exists()


def test_a_claim_taken_over_is_left_alone(spark, shop):
    spec, path = shop.spec(), shop.root / "table_claim"
    with claim.claimed(spark, spec):
        path.unlink()
        (shop.root / ".table_claim.crc").unlink(missing_ok=True)
        path.write_text("another")
    assert path.read_text() == "another"


def test_days_go_by_name_and_an_odd_one_holds_up_none(spark, shop):
    """Files of equal times, in a stream: whole days in the order of their names."""
    from conftest import INVOICE_COLUMNS, invoice

    from daybook.plans import ledger
    from daybook.streaming import ingest_new

    columns = [*INVOICE_COLUMNS[:-1], "Land"]
    shop.file("2010-12-02.csv", [invoice(1, "2010-12-02 08:00:00")], columns=columns)
    for day, suffix in ((4, ".b.csv"), (1, ".csv"), (4, ".a.csv"), (3, ".csv")):
        shop.day(f"2010-12-0{day}", day, suffix=suffix, first=100 * len(suffix))
    for path in (shop.root / "inbound").glob("*.csv"):
        os.utime(path, (1_291_000_000, 1_291_000_000))
    spec = shop.spec(days_per_load=1, columns=INVOICE_COLUMNS)
    ingest_new(spark, spec, str(shop.root / "ckpt"))
    lines = ledger.loaded_files(spark, spec).orderBy("at", "file_name").collect()
    assert [r["file_name"] for r in lines] == [
        "2010-12-01.csv", "2010-12-03.csv", "2010-12-04.a.csv", "2010-12-04.b.csv"
    ]
    assert [r["file_name"] for r in ledger.refused_files(spark, spec).collect()] == ["2010-12-02.csv"]
    assert len({r["load_id"] for r in lines}) == 3

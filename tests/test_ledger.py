"""The ledger's snapshot and tail."""

import pytest

from conftest import INVOICE_COLUMNS, invoice

from daybook import run
from daybook.plans import InterruptedLoadError, IncompleteDayError, ledger, load_files, settle
from daybook.sources import list_files


@pytest.fixture
def short_tail(monkeypatch):
    monkeypatch.setattr(ledger.compact, "__defaults__", (3,))


def tail(shop):
    return sorted(p.name for p in (shop.root / "table_ledger").glob("*.parquet"))


def snapshots(shop):
    return sorted(p.name for p in (shop.root / "table_ledger" / ledger.SNAPSHOTS).glob("*"))


def names(spark, spec):
    return sorted(r["file_name"] for r in ledger.loaded_files(spark, spec).collect())


def test_many_loads_leave_one_snapshot_and_a_short_tail(spark, shop, short_tail):
    spec = shop.spec()
    for day in range(1, 8):
        shop.day(f"2010-12-{day:02d}", day)
        run(spark, spec)
        assert len(tail(shop)) <= 3 and len(snapshots(shop)) <= 1
    assert names(spark, spec) == [f"2010-12-{day:02d}.csv" for day in range(1, 8)]
    assert run(spark, spec).status == "already_loaded"
    assert shop.counts() == {20101200 + day: day for day in range(1, 8)}
    assert ledger.interrupted_files(spark, spec).num_rows == 0


def test_a_file_loaded_again_and_again_is_one_line(spark, shop):
    shop.day("2010-12-01", 3)
    spec = shop.spec()
    for _ in range(3):
        load_files(spark, spec, list_files(spark, spec.inbound))
    assert len(names(spark, spec)) == 3
    assert ledger.compact(spark, spec, 0)
    assert names(spark, spec) == ["2010-12-01.csv"]
    assert run(spark, spec).status == "already_loaded" and shop.counts() == {20101201: 3}


def test_days_that_files_fed_survive(spark, shop):
    rows = [invoice(1, "2010-12-01 08:00:00"), invoice(2, "2010-12-02 08:00:00")]
    shop.file("2010-12-01.csv", rows)
    shop.day("2010-12-02", 2)
    run(spark, shop.spec(mode="append"))
    assert ledger.compact(spark, shop.spec(), 0)
    only = list_files(spark, shop.spec().inbound).where("file_name = '2010-12-02.csv'")
    with pytest.raises(IncompleteDayError, match="2010-12-01.csv appended"):
        load_files(spark, shop.spec(), only)


def test_an_open_load_stays_open(spark, shop, monkeypatch):
    spec = shop.spec(mode="append")
    shop.day("2010-12-01", 1)
    run(spark, spec)
    shop.day("2010-12-02", 2)
    with monkeypatch.context() as m:
        m.setattr(ledger, "finish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, spec)
    assert ledger.compact(spark, spec, 0)
    with pytest.raises(InterruptedLoadError):
        run(spark, spec)
    settle(spark, spec, loaded=True)
    assert ledger.compact(spark, spec, 0)
    assert run(spark, spec).status == "already_loaded"
    assert names(spark, spec) == ["2010-12-01.csv", "2010-12-02.csv"]


def test_a_compaction_that_died_counts_nothing_twice(spark, shop, monkeypatch):
    spec = shop.spec()
    for day in (1, 2):
        shop.day(f"2010-12-0{day}", day)
        run(spark, spec)
    before = tail(shop)
    with monkeypatch.context() as m:  # after the snapshot, ahead of the deletions
        m.setattr(ledger, "delete_paths", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.compact(spark, spec, 0)
    assert tail(shop) == before and len(snapshots(shop)) == 1
    assert names(spark, spec) == ["2010-12-01.csv", "2010-12-02.csv"]
    for marker in (shop.root / "table_ledger" / ledger.SNAPSHOTS).rglob("*_SUCCESS*"):
        marker.unlink()  # a snapshot whose write has not ended
    assert names(spark, spec) == ["2010-12-01.csv", "2010-12-02.csv"]
    assert ledger.compact(spark, spec, 0)
    assert names(spark, spec) == ["2010-12-01.csv", "2010-12-02.csv"] and not tail(shop)


def test_refused_files_and_a_new_table(spark, shop):
    spec = shop.spec()
    shop.day("2010-12-01", 1)
    run(spark, spec)
    columns = [*INVOICE_COLUMNS[:-1], "Land"]
    shop.file("2010-12-02.csv", [invoice(1, "2010-12-02 08:00:00")], columns=columns)
    assert run(spark, spec).refused == ("2010-12-02.csv",)
    assert ledger.compact(spark, spec, 0)
    run(spark, spec)
    assert [r["file_name"] for r in ledger.refused_files(spark, spec).collect()] == ["2010-12-02.csv"]
    spark.sql(f"DROP TABLE {shop.table}")
    (shop.root / "inbound" / "2010-12-02.csv").unlink()
    assert run(spark, spec).status == "created"
    assert not snapshots(shop) and names(spark, spec) == ["2010-12-01.csv"]


def test_a_day_of_a_table_without_a_ledger(spark, shop):
    shop.day("2010-12-01", 1)
    spec = shop.spec()
    run(spark, spec)
    for path in sorted((shop.root / "table_ledger").rglob("*"), reverse=True):
        path.unlink()
    (shop.root / "table_ledger").rmdir()
    shop.day("2010-12-02", 2)
    run(spark, spec)
    assert ledger.compact(spark, spec, 0)
    assert run(spark, spec).status == "already_loaded"
    assert shop.counts() == {20101201: 1, 20101202: 2}

import pytest

from conftest import INVOICE_COLUMNS, invoice

from daybook import run
from daybook.plans import ledger
from daybook.sources import list_files
from daybook.streaming import drain_staged, ingest_new

DAYS = {"2010-12-01": 3, "2010-12-02": 5, "2010-12-03": 2}


def fill(shop, folder="inbound"):
    for day, n in DAYS.items():
        shop.day(day, n, folder=folder)
    return {int(day.replace("-", "")): n for day, n in DAYS.items()}


@pytest.mark.parametrize("mode", ["append", "replace"])
@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_stream_is_batch_and_replays_change_nothing(spark, shop, mode, max_files):
    spec = shop.spec(mode=mode)
    expected = fill(shop)
    results = ingest_new(spark, spec, str(shop.root / "ckpt"), max_files)
    assert shop.counts() == expected
    assert sum(r.rows for r in results) == 10
    shop.day("2010-12-04", 4)
    ingest_new(spark, spec, str(shop.root / "ckpt"), max_files)
    expected[20101204] = 4
    assert shop.counts() == expected
    ingest_new(spark, spec, str(shop.root / "another"), max_files)
    assert shop.counts() == expected
    assert run(spark, spec).status == "already_loaded"


def test_a_day_spread_over_micro_batches(spark, shop):
    for part in range(4):
        shop.day("2010-12-01", 3, first=100 * part, suffix=f".{part}.csv")
    ingest_new(spark, shop.spec(), str(shop.root / "ckpt"), max_files=1)
    assert shop.counts() == {20101201: 12}


def test_drain_staged(spark, shop):
    expected = fill(shop, "staging")
    archive = shop.root / "archive"
    drain_staged(spark, shop.spec(), str(shop.root / "ckpt"), str(archive), max_files=1)
    assert shop.counts() == expected
    left = {p.name for p in (shop.root / "staging").glob("*.csv")}
    moved = {p.name for p in archive.rglob("*.csv")}
    assert left | moved == {f"{day}.csv" for day in DAYS}
    assert not left & moved
    assert run(spark, shop.spec(), request_load=True).status == "nothing_staged"


def test_stream_reads_one_folder(spark, shop):
    with pytest.raises(ValueError, match="one folder"):
        ingest_new(spark, shop.spec(inbound=["a", "b"]), str(shop.root / "ckpt"))


def test_a_glob_names_several_folders(spark, shop):
    shop.day("2010-12-01", 1)
    shop.day("2010-12-02", 2, folder="staging")
    spec = shop.spec(inbound=str(shop.root / "{inbound,staging}"), staging=None)
    ingest_new(spark, spec, str(shop.root / "ckpt"))
    assert shop.counts() == {20101201: 1, 20101202: 2}
    assert list_files(spark, spec.inbound).count() == 2


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_drained_days_in_several_files_and_late_ones(spark, shop, mode):
    spec, archive = shop.spec(mode=mode), str(shop.root / "archive")
    for part in range(4):
        shop.day("2010-12-01", 3, folder="staging", first=100 * part, suffix=f".{part}.csv")
    results = drain_staged(spark, spec, str(shop.root / "ckpt"), archive, max_files=1)
    assert [r.rows for r in results] == [3, 3, 3, 3]
    shop.day("2010-12-01", 5, folder="staging", first=900, suffix=".late.csv")
    shop.day("2010-12-02", 2, folder="staging")
    drain_staged(spark, spec, str(shop.root / "ckpt"), archive, max_files=1)
    assert shop.counts() == {20101201: 17, 20101202: 2}


def test_a_drain_that_died_finds_archived_files(spark, shop, monkeypatch):
    from daybook.plans import ledger

    archive = str(shop.root / "archive")
    for part in range(3):
        shop.day("2010-12-01", 3, folder="staging", first=100 * part, suffix=f".{part}.csv")
    drain_staged(spark, shop.spec(), str(shop.root / "ckpt"), archive, max_files=1)
    shop.day("2010-12-01", 5, folder="staging", first=900, suffix=".late.csv")
    original = ledger.finish
    monkeypatch.setattr(ledger, "finish", lambda *_: 1 / 0)
    with pytest.raises(Exception, match="division"):
        drain_staged(spark, shop.spec(), str(shop.root / "ckpt"), archive, max_files=1)
    monkeypatch.setattr(ledger, "finish", original)
    drain_staged(spark, shop.spec(), str(shop.root / "ckpt"), archive, max_files=1)
    assert shop.counts() == {20101201: 14}


def test_files_of_sub_folders_are_not_streamed(spark, shop):
    expected = fill(shop)
    for name in ("y=1", "old"):
        (shop.root / "inbound" / name).mkdir()
        shop.day("2010-11-30", 2, folder=f"inbound/{name}")
    ingest_new(spark, shop.spec(), str(shop.root / "ckpt"))
    assert shop.counts() == expected


@pytest.mark.parametrize("drain", [False, True])
def test_a_stream_gets_past_an_odd_file(spark, shop, drain):
    shop.day("2010-12-01", 1)
    spec, folder = shop.spec(), "staging" if drain else "inbound"
    run(spark, spec)

    def go():
        if drain:
            return drain_staged(spark, spec, str(shop.root / "ckpt"), str(shop.root / "archive"))
        return ingest_new(spark, spec, str(shop.root / "ckpt"))

    columns = [*INVOICE_COLUMNS[:-1], "Land"]
    shop.file("2010-12-02.csv", [invoice(1, "2010-12-02 08:00:00")], folder=folder, columns=columns)
    assert [x for r in go() for x in r.refused] == ["2010-12-02.csv"]
    shop.day("2010-12-03", 2, folder=folder)
    assert sum(r.rows for r in go()) == 2
    assert shop.counts() == {20101201: 1, 20101203: 2}
    assert [r["file_name"] for r in ledger.refused_files(spark, spec).collect()] == ["2010-12-02.csv"]

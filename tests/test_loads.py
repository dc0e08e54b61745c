"""The load job on small landing folders, one test per rule."""

import shutil
from dataclasses import replace

import pytest
from conftest import INVOICE_COLUMNS, invoice
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daybook import LoadSpec, load_files, run
from daybook.operators import load_profile
from daybook.plans import (
    ChangedFileError,
    IncompleteDayError,
    InterruptedLoadError,
    SchemaMismatchError,
    ledger,
    settle,
)
from daybook.settings import setting
from daybook.sources import MissingFolderError, content_digests, list_files, partition_keys


def inbound(spark, spec, *names):
    return list_files(spark, spec.inbound).where(F.col("file_name").isin(*names))


# --- first load -------------------------------------------------------------


def test_first_load_takes_all_files(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-02", 2)
    shop.file("junk.csv", [invoice(9, "2010-12-01 08:00:00")])
    done = run(spark, shop.spec())
    assert (done.status, done.rows, done.files) == (
        "created",
        5,
        ("2010-12-01.csv", "2010-12-02.csv"),
    )
    assert (done.min_datestr, done.max_datestr, done.null_keys) == (20101201, 20101202, 0)
    assert shop.counts() == {20101201: 3, 20101202: 2}
    assert shop.rows().columns == [*INVOICE_COLUMNS, "datestr"]
    assert spark.catalog.getTable(shop.table).tableType == "EXTERNAL"


def test_classic_first_load_takes_the_latest_file(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-02", 2)
    done = run(spark, shop.classic(), request_load=True)
    assert (done.status, shop.counts()) == ("created", {20101202: 2})


def test_missing_and_empty_inbound(spark, shop):
    with pytest.raises(MissingFolderError):
        run(spark, shop.spec(inbound=str(shop.root / "nowhere")))
    assert run(spark, shop.spec()).status == "no_files"


def test_missing_database(spark, shop):
    shop.day("2010-12-01", 1)
    with pytest.raises(AnalysisException, match="nowhere"):
        run(spark, shop.spec(table="nowhere.t"))
    assert not spark.catalog.databaseExists("nowhere")


def test_a_table_made_anew_forgets_the_old_ledger(spark, shop):
    shop.day("2010-12-01", 3)
    run(spark, shop.spec())
    spark.sql(f"DROP TABLE {shop.table}")
    assert run(spark, shop.spec()).status == "created"
    assert run(spark, shop.spec()).status == "already_loaded"
    assert shop.counts() == {20101201: 3}


# --- which files are pending ------------------------------------------------


def test_late_file(spark, shop):
    shop.day("2010-12-03", 2)
    run(spark, shop.spec())
    shop.day("2010-12-01", 3)
    assert run(spark, shop.spec()).files == ("2010-12-01.csv",)
    assert run(spark, shop.spec()).status == "already_loaded"
    assert shop.counts() == {20101201: 3, 20101203: 2}


def test_classic_appends_a_late_file_on_every_run(spark, shop):
    shop.day("2010-12-03", 2)
    run(spark, shop.classic())
    (shop.root / "inbound" / "2010-12-03.csv").unlink()
    shop.day("2010-12-01", 3)
    for _ in range(2):
        assert run(spark, shop.classic()).status == "appended"
    assert shop.counts() == {20101201: 6, 20101203: 2}


def test_gap_is_filled(spark, shop):
    shop.day("2010-12-01", 1)
    run(spark, shop.spec())
    shop.day("2010-12-02", 2)
    shop.day("2010-12-03", 3)
    run(spark, shop.spec())
    assert shop.counts() == {20101201: 1, 20101202: 2, 20101203: 3}


def test_classic_skips_the_gap(spark, shop):
    shop.day("2010-12-01", 1)
    run(spark, shop.classic())
    shop.day("2010-12-02", 2)
    shop.day("2010-12-03", 3)
    run(spark, shop.classic())
    assert shop.counts() == {20101201: 1, 20101203: 3}


def test_high_water_without_latest_only_takes_all_later_files(spark, shop):
    spec = shop.spec(check="high_water")
    shop.day("2010-12-02", 1)
    run(spark, spec)
    for day in ("2010-12-01", "2010-12-03", "2010-12-04"):
        shop.day(day, 2)
    assert run(spark, spec).files == ("2010-12-03.csv", "2010-12-04.csv")


def test_already_loaded_writes_nothing(spark, shop):
    shop.day("2010-12-01", 3)
    for spec in (shop.spec(), shop.classic()):
        run(spark, spec)
        written = sorted((shop.root / "table").rglob("*.parquet"))
        assert run(spark, spec).status == "already_loaded"
        assert sorted((shop.root / "table").rglob("*.parquet")) == written


@pytest.mark.parametrize("kind", ["spec", "classic"])
def test_existing_empty_table(spark, shop, kind):
    columns = ", ".join(f"{c} string" for c in INVOICE_COLUMNS)
    spark.sql(
        f"CREATE TABLE {shop.table} ({columns}, datestr int) USING parquet "
        f"PARTITIONED BY (datestr) LOCATION '{shop.root / 'table'}'"
    )
    shop.day("2010-12-01", 3)
    run(spark, getattr(shop, kind)())
    assert shop.counts() == {20101201: 3}


def test_table_without_a_ledger_counts_its_days_as_loaded(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-02", 2)
    run(spark, shop.classic())
    shutil.rmtree(shop.root / "table_ledger")
    assert run(spark, shop.spec(mode="append")).files == ("2010-12-01.csv",)
    assert run(spark, shop.spec(mode="append")).status == "already_loaded"
    assert shop.counts() == {20101201: 3, 20101202: 2}


# --- requested loads --------------------------------------------------------


@pytest.mark.parametrize("kind", ["spec", "classic"])
def test_requested_load_takes_the_earliest_staged_file(spark, shop, kind):
    spec = getattr(shop, kind)()
    shop.day("2010-12-02", 2)
    for day in ("2010-12-03", "2010-12-04"):
        shop.day(day, 3, folder="staging")
    run(spark, spec)
    assert run(spark, spec, request_load=True).files == ("2010-12-03.csv",)
    assert run(spark, spec).status == "already_loaded"
    assert run(spark, spec, request_load=True).files == ("2010-12-04.csv",)
    assert run(spark, spec, request_load=True).status == "nothing_staged"
    assert shop.counts() == {20101202: 2, 20101203: 3, 20101204: 3}


def test_staged_file_older_than_inbound_is_the_one_loaded(spark, shop):
    shop.day("2010-12-03", 2)
    shop.day("2010-12-01", 3, folder="staging")
    run(spark, shop.classic())
    assert run(spark, shop.classic(), request_load=True).files == ("2010-12-01.csv",)
    assert shop.counts() == {20101201: 3, 20101203: 2}


def test_request_has_no_effect_while_a_file_is_pending(spark, shop):
    shop.day("2010-12-01", 1)
    shop.day("2010-12-05", 1, folder="staging")
    run(spark, shop.spec())
    shop.day("2010-12-02", 2)
    assert run(spark, shop.spec(), request_load=True).files == ("2010-12-02.csv",)


def test_request_needs_a_staging_folder(spark, shop):
    shop.day("2010-12-01", 1)
    run(spark, shop.spec(staging=None))
    with pytest.raises(ValueError, match="staging"):
        run(spark, shop.spec(staging=None), request_load=True)


# --- appending and replacing ------------------------------------------------


def test_same_file_twice(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-02", 2)
    run(spark, shop.spec())
    load_files(spark, shop.spec(), inbound(spark, shop.spec(), "2010-12-02.csv"))
    assert shop.counts() == {20101201: 3, 20101202: 2}
    appending = shop.spec(mode="append")
    done = load_files(spark, appending, inbound(spark, appending, "2010-12-02.csv"))
    assert (done.status, done.rows) == ("appended", 2)
    assert tuple(load_profile(shop.rows()).first()) == (7, 5)


def test_session_setting_is_left_as_it_was(spark, shop):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    shop.day("2010-12-01", 3)
    for _ in range(2):
        load_files(spark, shop.spec(), list_files(spark, shop.spec().inbound))
    assert spark.conf.get(name) == before


def test_a_day_in_several_files(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-01", 4, first=100, suffix=".1.csv")
    run(spark, shop.spec())
    assert shop.counts() == {20101201: 7}
    shop.day("2010-12-01", 5, first=200, suffix=".2.csv")
    done = run(spark, shop.spec())
    assert (done.status, done.rows, done.files) == ("replaced", 5, ("2010-12-01.2.csv",))
    assert shop.counts() == {20101201: 12}
    again = load_files(spark, shop.spec(), inbound(spark, shop.spec(), "2010-12-01.1.csv"))
    assert (again.rows, len(again.files), shop.counts()) == (12, 3, {20101201: 12})


def test_a_day_whose_files_are_gone_is_not_replaced(spark, shop):
    shop.day("2010-12-01", 3)
    run(spark, shop.spec())
    (shop.root / "inbound" / "2010-12-01.csv").unlink()
    shop.day("2010-12-01", 4, first=100, suffix=".1.csv")
    run(spark, shop.spec())
    assert shop.counts() == {20101201: 7}
    for names in (["2010-12-01.1.csv"], ["2010-12-01.csv", "2010-12-01.1.csv"]):
        with pytest.raises(IncompleteDayError, match="2010-12-01.csv"):
            load_files(spark, shop.spec(), inbound(spark, shop.spec(), *names))
    assert shop.counts() == {20101201: 7}


def test_late_inbound_file_for_a_fetched_day(spark, shop):
    shop.day("2010-12-01", 1)
    shop.day("2010-12-02", 2, folder="staging")
    shop.day("2010-12-02", 9, folder="staging", first=500, suffix=".9.csv")
    run(spark, shop.spec())
    run(spark, shop.spec(), request_load=True)
    shop.day("2010-12-02", 3, first=100, suffix=".1.csv")
    run(spark, shop.spec())
    assert shop.counts() == {20101201: 1, 20101202: 14}


def test_mixed_days_are_appended_to_their_own_partitions(spark, shop):
    shop.file(
        "2010-12-01.csv",
        [invoice(1, "2010-12-01 08:00:00"), invoice(2, "2010-12-02 08:00:00"), invoice(3, "bad")],
    )
    for rebalance in (False, True):
        spec = shop.spec(mode="append", rebalance=rebalance)
        done = load_files(spark, spec, list_files(spark, spec.inbound))
        assert (done.rows, done.null_keys, done.quarantined) == (3, 1, 0)
    assert shop.counts() == {20101201: 2, 20101202: 2, None: 2}
    assert {r[0] for r in partition_keys(spark, shop.table).collect()} == {20101201, 20101202}


def test_replace_mode_quarantines_rows_of_other_days(spark, shop):
    shop.file(
        "2010-12-01.csv",
        [invoice(1, "2010-12-01 08:00:00"), invoice(2, "2010-12-02 08:00:00"), invoice(3, "bad")],
    )
    spec = shop.spec()
    for _ in range(2):
        done = load_files(spark, spec, list_files(spark, spec.inbound))
        assert (done.rows, done.quarantined, done.null_keys) == (1, 2, 1)
    shop.day("2010-12-02", 4)
    run(spark, spec)
    assert shop.counts() == {20101201: 1, 20101202: 4}
    kept = spark.read.parquet(spec.quarantine_path)
    assert {(r["InvoiceNo"], r["datestr"], r["_source_file"]) for r in kept.collect()} == {
        ("2", 20101202, "2010-12-01.csv"),
        ("3", None, "2010-12-01.csv"),
    }
    assert kept.count() == 2


def test_a_day_whose_file_lost_its_rows_is_emptied(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-02", 2)
    run(spark, shop.spec())
    shop.file("2010-12-02.csv", [])
    load_files(spark, shop.spec(), inbound(spark, shop.spec(), "2010-12-02.csv"))
    assert shop.counts() == {20101201: 3}
    shop.file("2010-12-01.csv", [invoice(1, "2010-12-05 08:00:00")])
    done = load_files(spark, shop.spec(), list_files(spark, shop.spec().inbound))
    assert (done.rows, done.quarantined, shop.counts()) == (0, 1, {})
    assert {r[0] for r in partition_keys(spark, shop.table).collect()} == set()


def test_only_files_with_strays_are_read_again(spark, shop, monkeypatch):
    from daybook.plans import loads

    read, original = [], loads._read_batch

    def noting(session, spec, files, *more):
        read.append(files["file_name"].to_pylist())
        return original(session, spec, files, *more)

    monkeypatch.setattr(loads, "_read_batch", noting)
    shop.day("2010-12-01", 3)
    shop.file("2010-12-02.csv", [invoice(1, "2010-12-03 08:00:00"), invoice(2, "2010-12-02")])
    done = run(spark, shop.spec())
    assert (done.rows, done.quarantined) == (4, 1)
    assert [sorted(names) for names in read] == [
        ["2010-12-01.csv", "2010-12-02.csv"],
        ["2010-12-02.csv"],
    ]


def test_quarantine_holds_what_the_last_load_left_over(spark, shop):
    spec = shop.spec()

    def kept():
        rows = spark.read.parquet(spec.quarantine_path).collect()
        return {(r["InvoiceNo"], r["_source_day"]) for r in rows}

    for day in ("01", "02"):
        shop.file(f"2010-12-{day}.csv", [invoice(1, f"2010-12-{day}"), invoice(2, "bad")])
    run(spark, spec)
    assert kept() == {("2", 20101201), ("2", 20101202)}
    shop.day("2010-12-01", 3)
    load_files(spark, spec, inbound(spark, spec, "2010-12-01.csv"))
    assert kept() == {("2", 20101202)}
    shop.file("2010-12-02.csv", [invoice(7, "bad")])
    load_files(spark, spec, inbound(spark, spec, "2010-12-02.csv"))
    assert kept() == {("7", 20101202)}
    assert shop.counts() == {20101201: 3}


def test_header_only_file(spark, shop):
    shop.day("2010-12-01", 3)
    run(spark, shop.spec())
    shop.file("2010-12-02.csv", [])
    done = run(spark, shop.spec())
    assert (done.rows, done.files) == (0, ("2010-12-02.csv",))
    assert run(spark, shop.spec()).status == "already_loaded"
    assert shop.counts() == {20101201: 3}


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_reordered_header_is_aligned_by_name(spark, shop, mode):
    shop.day("2010-12-01", 1)
    run(spark, shop.spec(mode=mode))
    turned = [invoice(7, "2010-12-02 08:00:00")[::-1]]
    shop.file("2010-12-02.csv", turned, columns=INVOICE_COLUMNS[::-1])
    run(spark, shop.spec(mode=mode))
    row = shop.rows().where("datestr = 20101202").first()
    assert (row["InvoiceNo"], row["Country"]) == ("7", "United Kingdom")


OTHER_COLUMNS = [*INVOICE_COLUMNS[:-1], "Land"]


def test_other_columns_are_refused_and_noted_once(spark, shop):
    shop.day("2010-12-01", 1)
    spec = shop.spec()
    run(spark, spec)
    shop.file("2010-12-02.csv", [invoice(7, "2010-12-02 08:00:00")], columns=OTHER_COLUMNS)
    for _ in range(2):
        done = run(spark, spec)
        assert (done.status, done.refused) == ("already_loaded", ("2010-12-02.csv",))
    assert [r["file_name"] for r in ledger.refused_files(spark, spec).collect()] == ["2010-12-02.csv"]
    assert shop.counts() == {20101201: 1}
    shop.day("2010-12-02", 3)  # put right under its name
    done = run(spark, spec)
    assert (done.rows, done.refused) == (3, ())
    assert shop.counts() == {20101201: 1, 20101202: 3}


@pytest.mark.parametrize("odd", ["2010-12-02.csv", "2010-12-03.csv", "2010-12-04.csv"])
@pytest.mark.parametrize("mode", ["append", "replace"])
def test_an_odd_file_holds_up_only_itself(spark, shop, odd, mode):
    shop.day("2010-12-01", 1)
    spec = shop.spec(mode=mode)
    run(spark, spec)
    expected = {20101201: 1}
    for k, name in enumerate(["2010-12-02.csv", "2010-12-03.csv", "2010-12-04.csv"]):
        day = name[:10]
        if name == odd:
            shop.file(name, [invoice(8, f"{day} 08:00:00")], columns=OTHER_COLUMNS)
        else:
            shop.file(name, [invoice(k, f"{day} 08:00:00")[::-1]], columns=INVOICE_COLUMNS[::-1])
            expected[int(day.replace("-", ""))] = 1
    done = run(spark, spec)
    assert (done.rows, done.refused) == (2, (odd,))
    assert shop.counts() == expected
    assert {r["Country"] for r in shop.rows().collect()} == {"United Kingdom"}


def test_columns_of_a_first_load(spark, shop):
    """Those most files have, wherever the odd ones sort; no table if that is undecided."""
    shop.file("2010-12-01.csv", [invoice(1, "2010-12-01 08:00:00")], columns=OTHER_COLUMNS)
    shop.day("2010-12-02", 2)
    spec = shop.spec()
    with pytest.raises(SchemaMismatchError, match="LoadSpec.columns"):
        run(spark, spec)
    assert not spark.catalog.tableExists(spec.table)
    named = replace(spec, columns=INVOICE_COLUMNS[::-1])
    assert run(spark, replace(spec, columns=["a", "b"])).status == "no_files"
    done = run(spark, named)
    assert (done.status, done.rows, done.refused) == ("created", 2, ("2010-12-01.csv",))
    assert shop.rows().columns == [*INVOICE_COLUMNS[::-1], "datestr"]
    spark.sql(f"DROP TABLE {spec.table}")
    shop.day("2010-12-03", 3)
    done = run(spark, spec)
    assert (done.status, done.rows, done.refused) == ("created", 5, ("2010-12-01.csv",))
    assert shop.rows().columns == [*INVOICE_COLUMNS, "datestr"]
    assert [r["file_name"] for r in ledger.refused_files(spark, spec).collect()] == ["2010-12-01.csv"]


def test_an_odd_file_of_a_replaced_day_is_an_error(spark, shop):
    shop.day("2010-12-01", 2)
    run(spark, shop.spec())
    shop.file("2010-12-01.b.csv", [invoice(7, "2010-12-01 08:00:00")], columns=OTHER_COLUMNS)
    with pytest.raises(SchemaMismatchError, match="Land"):
        load_files(spark, shop.spec(), inbound(spark, shop.spec(), "2010-12-01.csv"))
    assert shop.counts() == {20101201: 2}


def test_a_requested_load_passes_odd_days(spark, shop):
    shop.day("2010-12-01", 1)
    run(spark, shop.spec())
    for day in ("02", "03"):
        rows = [invoice(8, f"2010-12-{day} 08:00:00")]
        shop.file(f"2010-12-{day}.csv", rows, folder="staging", columns=OTHER_COLUMNS)
    shop.day("2010-12-04", 3, folder="staging")
    done = run(spark, shop.spec(), request_load=True)
    assert (done.rows, done.refused) == (3, ("2010-12-02.csv", "2010-12-03.csv"))
    done = run(spark, shop.spec(), request_load=True)
    assert (done.status, done.refused) == ("nothing_staged", ("2010-12-02.csv", "2010-12-03.csv"))


def test_status_ahead_of_the_write(spark, shop):
    shop.day("2010-12-01", 3)
    run(spark, shop.spec())
    shop.day("2010-12-02", 2)
    done = run(spark, shop.spec(), pre_status=True)
    assert [tuple(r) for r in done.before] == [(20101201, 3)]
    assert done.rows == 2


def test_one_by_one_is_all_at_once(spark, shop):
    days = {"2010-12-01": 3, "2010-12-02": 5, "2010-12-03": 2}
    for day, n in days.items():
        shop.day(day, n)
        run(spark, shop.spec())
    one_by_one = {tuple(r) for r in shop.rows().collect()}
    spark.sql(f"DROP TABLE {shop.table}")
    run(spark, shop.spec())
    assert {tuple(r) for r in shop.rows().collect()} == one_by_one


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats(spark, shop, fmt):
    spec = shop.spec(fmt=fmt)
    shop.day("2010-12-01", 3)
    run(spark, spec)
    shop.day("2010-12-02", 2)
    run(spark, spec)
    assert shop.counts() == {20101201: 3, 20101202: 2}


def test_avro_is_passed_on(spark, shop):
    shop.day("2010-12-01", 1)
    with pytest.raises(AnalysisException, match="(?i)avro"):
        run(spark, shop.spec(fmt="avro"))


def test_files_from_another_folder(spark, shop):
    shop.day("2010-12-01", 1)
    run(spark, shop.spec())
    (shop.root / "elsewhere").mkdir()
    shop.day("2010-12-02", 2, folder="elsewhere")
    shop.day("2010-12-01", 3, folder="elsewhere", first=100, suffix=".1.csv")
    given = list_files(spark, str(shop.root / "elsewhere"))
    assert load_files(spark, shop.spec(), given).rows == 5
    assert shop.counts() == {20101201: 4, 20101202: 2}


def test_counts_ledger_and_table_agree(spark, shop):
    for day, n in (("2010-12-01", 3), ("2010-12-02", 2), ("2010-12-05", 4)):
        shop.day(day, n)
        done = run(spark, shop.spec(), report=True)
    report = {(r["metric"], r["datestr"]): r["value"] for r in done.report.collect()}
    per_day = {day: n for (metric, day), n in report.items() if metric == "rows"}
    assert per_day == shop.counts()
    assert sum(per_day.values()) == report["total", None] == report["unique", None] == 9
    ledger = spark.read.parquet(shop.spec().ledger_path)
    assert {r["file_value"] for r in ledger.collect()} == set(per_day)
    assert {r[0] for r in partition_keys(spark, shop.table).collect()} == set(per_day)


def test_report_when_there_is_nothing_to_load(spark, shop):
    shop.day("2010-12-01", 3)
    assert run(spark, shop.spec()).report is None
    lines = {tuple(r) for r in run(spark, shop.spec()).report.collect()}
    assert lines == {("rows", 20101201, 3), ("total", None, 3), ("unique", None, 3)}


@pytest.mark.parametrize("layout", ["", "PARTITIONED BY (Country)"])
def test_days_of_a_table_not_partitioned_by_day(spark, shop, layout):
    spark.sql(f"CREATE TABLE {shop.table} (datestr int, Country string) USING parquet {layout}")
    spark.sql(f"INSERT INTO {shop.table} VALUES (20101201, 'x'), (20101202, 'y'), (NULL, 'y')")
    assert {r[0] for r in partition_keys(spark, shop.table).collect()} == {20101201, 20101202}


def test_unknown_settings():
    for wrong in ({"mode": "x"}, {"check": "x"}, {"table": ""}, {"location": ""}):
        with pytest.raises(ValueError):
            LoadSpec(**{"table": "t", "location": "l", "inbound": "i", **wrong})


# --- loads that die, files that change --------------------------------------


STEPS = ["create_table", "append_rows", "replace_days", "quarantine"]


def dying(monkeypatch, step, before):
    """Make one step of a load raise, ahead of its work or after it."""
    from daybook.plans import ledger, writes

    where = ledger if step in ("start", "finish") else writes
    original = getattr(where, step)

    def step_and_die(*args, **kwargs):
        if not before:
            original(*args, **kwargs)
        raise SystemError("died")

    monkeypatch.setattr(where, step, step_and_die)


@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("step", [*STEPS, "start", "finish"])
def test_a_replacing_load_that_dies_loses_and_doubles_nothing(spark, shop, monkeypatch, step, before):
    stray = [invoice(9, "bad")]
    first = step in ("create_table", "quarantine", "start", "finish")
    shop.file("2010-12-01.csv", [invoice(1, "2010-12-01"), *stray])
    if not first:
        run(spark, shop.spec())
        shop.day("2010-12-01", 2, first=50, suffix=".0.csv")
    given = inbound(spark, shop.spec(), "2010-12-01.csv")
    dying(monkeypatch, step, before)
    with pytest.raises(SystemError):
        if step == "replace_days":
            load_files(spark, shop.spec(), given)
        else:
            run(spark, shop.spec())
    monkeypatch.undo()
    shop.day("2010-12-01", 3, first=100, suffix=".1.csv")
    shop.day("2010-12-02", 4)
    run(spark, shop.spec())
    assert shop.counts() == {20101201: 4 if first else 6, 20101202: 4}
    kept = spark.read.parquet(shop.spec().quarantine_path)
    assert [r["InvoiceNo"] for r in kept.collect()] == ["9"]
    assert run(spark, shop.spec()).status == "already_loaded"


@pytest.mark.parametrize("written", [True, False])
def test_an_appending_load_that_dies_asks(spark, shop, monkeypatch, written):
    spec = shop.spec(mode="append")
    shop.day("2010-12-01", 3)
    run(spark, spec)
    shop.day("2010-12-02", 2)
    dying(monkeypatch, "append_rows", not written)
    with pytest.raises(SystemError):
        run(spark, spec)
    monkeypatch.undo()
    for _ in range(2):
        with pytest.raises(InterruptedLoadError, match="2010-12-02.csv"):
            run(spark, spec)
    settle(spark, spec, loaded=written)
    assert run(spark, spec).status == ("already_loaded" if written else "appended")
    assert shop.counts() == {20101201: 3, 20101202: 2}


def test_a_first_appending_load_that_dies_before_the_table_is_there(spark, shop, monkeypatch):
    shop.day("2010-12-01", 3)
    dying(monkeypatch, "create_table", True)
    with pytest.raises(SystemError):
        run(spark, shop.spec(mode="append"))
    monkeypatch.undo()
    assert run(spark, shop.spec(mode="append")).status == "created"
    assert shop.counts() == {20101201: 3}


def test_a_day_that_other_files_fed_is_not_replaced(spark, shop):
    shop.file("2010-12-01.csv", [invoice(1, "2010-12-01"), invoice(2, "2010-12-02")])
    run(spark, shop.spec(mode="append"))
    shop.day("2010-12-02", 4, first=10)
    run(spark, shop.spec())
    assert shop.counts() == {20101201: 1, 20101202: 5}
    with pytest.raises(IncompleteDayError, match="2010-12-01.csv"):
        load_files(spark, shop.spec(), inbound(spark, shop.spec(), "2010-12-02.csv"))
    assert shop.counts() == {20101201: 1, 20101202: 5}


def test_changed_files_are_refused_and_moved_ones_are_known(spark, shop):
    shop.day("2010-12-01", 3)
    shop.day("2010-12-02", 2, folder="staging")
    run(spark, shop.spec())
    run(spark, shop.spec(), request_load=True)
    shutil.move(shop.root / "staging" / "2010-12-02.csv", shop.root / "inbound" / "2010-12-02.csv")
    assert run(spark, shop.spec()).status == "already_loaded"
    shop.day("2010-12-01", 5, folder="staging")
    with pytest.raises(ChangedFileError, match="staging/2010-12-01.csv"):
        run(spark, shop.spec(), request_load=True)
    (shop.root / "staging" / "2010-12-01.csv").unlink()
    shop.day("2010-12-01", 5)
    with pytest.raises(ChangedFileError, match="inbound/2010-12-01.csv"):
        run(spark, shop.spec())
    load_files(spark, shop.spec(), inbound(spark, shop.spec(), "2010-12-01.csv"))
    assert run(spark, shop.spec()).status == "already_loaded"
    assert shop.counts() == {20101201: 5, 20101202: 2}


def test_files_of_one_name_and_length_elsewhere(spark, shop):
    """Lines tell them apart; a copy is known, and looked at once only."""
    spec = shop.spec(inbound=[str(shop.root / "inbound"), str(shop.root / "staging")], staging=None)
    shop.day("2010-12-01", 3)
    run(spark, spec)
    shop.day("2010-12-01", 3, folder="staging")
    assert run(spark, spec).status == "already_loaded"
    noted = spark.read.parquet(spec.ledger_path).where("path LIKE '%staging%'").collect()
    assert len(noted) == 1 and noted[0]["state"] == "finished"
    assert run(spark, spec).status == "already_loaded"
    assert spark.read.parquet(spec.ledger_path).where("path LIKE '%staging%'").count() == 1
    other = shop.root / "staging" / "2010-12-01.csv"
    size = other.stat().st_size
    shop.day("2010-12-01", 3, folder="staging", first=5)
    assert other.stat().st_size == size
    with pytest.raises(ChangedFileError, match="staging/2010-12-01.csv"):
        run(spark, spec)
    assert shop.counts() == {20101201: 3}


def test_digests(spark, tmp_path):
    """The order of lines and how a file is split are no matter; each line and its repeats are."""
    texts = {
        "a.csv": "h\n1\n2\n", "b.csv": "h\n2\n1\n", "c.csv": "h\n1\n2\n2\n", "d%20 [x].csv": "h\n1\n3\n",
        "e.csv": "\n\nh,x\n", "f.csv": "\n", "g.csv": "h\n" + "\n".join(map(str, range(5000))),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    paths = [f"file:{tmp_path}/{name}" for name in texts]
    found = dict(zip(texts, content_digests(spark, paths).values(), strict=True))
    assert [found[n][0] for n in texts] == ["h", "h", "h", "h", "h,x", None, "h"]
    assert found["a.csv"] == found["b.csv"]
    assert len({found[n][1] for n in texts}) == 6
    with setting(spark, "spark.sql.files.maxPartitionBytes", "1000"):
        assert list(content_digests(spark, paths).values()) == list(found.values())
    assert content_digests(spark, []) == {}


def test_odd_names_are_read_once_each(spark, shop):
    names = ["p1", "p[1]", "p{1,2}", "p*", "p?", "p 1", "p%20", "p$", "p^1"]
    for k, name in enumerate(names):
        shop.day("2010-12-01", k + 1, first=100 * k, suffix=f".{name}.csv")
    done = run(spark, shop.spec())
    assert (done.rows, len(done.files)) == (45, 9)
    assert shop.rows().select("InvoiceNo").distinct().count() == 45
    assert run(spark, shop.spec()).status == "already_loaded"


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_malformed_rows(spark, shop, mode):
    path = shop.root / "inbound" / "2010-12-01.csv"
    shop.day("2010-12-01", 2)
    fine = path.read_text().splitlines()[1]
    path.write_text(path.read_text() + fine + ",extra,fields\n" + ",".join(fine.split(",")[:5]) + "\n")
    done = run(spark, shop.spec(mode=mode))
    assert done.malformed == 2
    if mode == "append":
        assert (done.rows, done.quarantined, shop.counts()) == (4, 0, {20101201: 4})
    else:
        assert (done.rows, done.quarantined, shop.counts()) == (2, 2, {20101201: 2})
        kept = spark.read.parquet(shop.spec().quarantine_path)
        assert all(r["_malformed"].startswith("0,21421") for r in kept.collect())


def test_reader_options(spark, shop):
    path = shop.root / "inbound" / "2010-12-01.csv"
    row = invoice(1, "2010-12-01 08:00:00", description='"two\nlines"')
    path.write_text(";".join(INVOICE_COLUMNS) + "\n" + ";".join(row) + "\n")
    done = run(spark, shop.spec(options={"sep": ";", "multiLine": "true"}))
    assert (done.rows, done.malformed) == (1, 0)
    assert shop.rows().first()["Description"] == "two\nlines"


def test_a_load_in_groups_of_days_keeps_what_it_finished(spark, shop, monkeypatch):
    from daybook.plans import writes

    for day in range(1, 7):
        shop.day(f"2010-12-0{day}", day)
    spec = shop.spec(days_per_load=2)
    appended, original = [], writes.append_rows

    def second_dies(batch, spec):
        appended.append(1)
        if len(appended) == 2:
            raise SystemError("died")
        original(batch, spec)

    monkeypatch.setattr(writes, "append_rows", second_dies)
    with pytest.raises(SystemError):
        run(spark, spec)
    monkeypatch.undo()
    assert shop.counts() == {20101200 + d: d for d in range(1, 5)}
    done = run(spark, spec)
    assert (done.days, done.rows) == ((20101205, 20101206), 11)
    assert shop.counts() == {20101200 + d: d for d in range(1, 7)}


def test_report_on_the_loaded_days(spark, shop):
    shop.day("2010-12-01", 3)
    run(spark, shop.spec())
    shop.day("2010-12-02", 2)
    report = run(spark, shop.spec(), report="loaded").report
    assert {tuple(r) for r in report.collect()} == {
        ("rows", 20101202, 2), ("total", None, 2), ("unique", None, 2),
    }
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datestr" in plan or "datestr#" in plan.split("PartitionFilters")[1][:80]


def test_emptied_days_cost_no_jobs(spark, shop):
    days = [f"2010-12-{d:02d}" for d in range(1, 13)]
    for day in days:
        shop.day(day, 2)
    run(spark, shop.spec())
    jobs = []
    for n in (1, 8):
        for day in days[:n]:
            shop.file(f"{day}.csv", [])
        days = days[n:]
        group = f"emptied-{n}"
        spark.sparkContext.setJobGroup(group, group)
        load_files(spark, shop.spec(), list_files(spark, shop.spec().inbound))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(shop.counts()) == len(days)
    assert jobs[0] > 0 and jobs[1] <= jobs[0]
    assert {r[0] for r in partition_keys(spark, shop.table).collect()} == {
        int(d.replace("-", "")) for d in days
    }

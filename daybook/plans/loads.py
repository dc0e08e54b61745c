"""The load job: choose files, load them, say what happened."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from daybook.functions import file_key
from daybook.operators import high_water_mark, partition_counts, post_load_report
from daybook.operators.files import keyed
from daybook.plans import ledger, writes
from daybook.plans.claim import claimed
from daybook.plans.report import incremental_report
from daybook.plans.spec import LoadSpec
from daybook.settings import files_in_few_tasks, listing_in_few_tasks
from daybook.sources.catalogue import with_headers
from daybook.sources.landing import DAY, file_frame, list_files, literal, read_days
from daybook.sources.tables import partition_keys, table_exists

SOURCE_FILE = "_source_file"
MALFORMED = "_malformed"
FILE_COLUMNS = ["path", "file_name", "file_value", "length", "modified"]


class IncompleteDayError(RuntimeError):
    """A day cannot be replaced: files it was loaded from are gone, or hold other days too."""


@dataclass(frozen=True)
class LoadResult:
    """What one run did.

    status      created, appended, replaced, already_loaded, nothing_staged or
                no_files
    files       names of the loaded files
    rows        rows written to the table
    quarantined rows kept aside because they lack their file's day
    null_keys   rows without a readable day, wherever they went
    malformed   rows with too few or too many fields: in ``replace`` mode they are
                among the quarantined, with their text; in ``append`` mode they are
                loaded, cut or filled up with NULL
    days        days of the loaded files
    refused     files left out because they have other columns than the table; the ledger
                notes them, and they stay pending
    before      (datestr, row_count) ahead of the write, if asked for
    report      rows per day, total and unique rows of the table, not yet
                computed: if asked for, and always if there was nothing to load
    """

    status: str
    files: tuple[str, ...] = ()
    rows: int = 0
    quarantined: int = 0
    null_keys: int = 0
    min_datestr: int | None = None
    max_datestr: int | None = None
    malformed: int = 0
    days: tuple[int, ...] = ()
    refused: tuple[str, ...] = ()
    before: list[Row] = field(default_factory=list)
    report: DataFrame | None = None


def run(
    spark: SparkSession,
    spec: LoadSpec,
    request_load: bool = False,
    pre_status: bool = False,
    report: bool | str = False,
) -> LoadResult:
    """Load what is pending in the inbound folders.

    If nothing is, ``request_load`` takes the next staged day instead. The flag
    has no effect as long as an inbound file is pending. ``report`` is about the
    whole table, or, if it is ``"loaded"``, about the days this run loaded; with
    ``"incremental"`` it is about the whole table and reads only the days whose files
    changed since the last such report.
    """
    with claimed(spark, spec):
        done = _run(spark, spec, request_load, pre_status)
    if report == "incremental" and table_exists(spark, spec.table):
        done = replace(done, report=incremental_report(spark, spec))
    elif done.status == "already_loaded" or (report and table_exists(spark, spec.table)):
        days = list(done.days) if report == "loaded" else None
        done = replace(done, report=post_load_report(spark.table(spec.table), days=days))
    return done


def _run(
    spark: SparkSession, spec: LoadSpec, request_load: bool, pre_status: bool
) -> LoadResult:
    if "." in spec.table:
        spark.catalog.getDatabase(spec.table.rsplit(".", 1)[0])  # an error that names it
    inbound = list_files(spark, spec.inbound)
    if not table_exists(spark, spec.table):
        return load_files(spark, spec, _only_latest(inbound, spec))

    loaded = ledger.loaded_files(spark, spec)
    if spec.check == "ledger":
        ledger.refuse_changed(spark, spec, keyed(inbound), loaded)
        pending = ledger.without_loaded(_only_latest(inbound, spec), loaded)
    else:
        pending = _past_high_water(spark, spec, inbound, loaded)
    done = load_files(spark, spec, pending, pre_status=pre_status)
    if done.status != "no_files":
        return done
    if not request_load:
        return replace(done, status="already_loaded")
    if spec.staging is None:
        raise ValueError("a requested load needs a staging folder")
    staged = keyed(list_files(spark, spec.staging))
    ledger.refuse_changed(spark, spec, staged, loaded)
    staged = ledger.without_loaded(staged, loaded)
    refused: tuple[str, ...] = ()
    while True:
        pending = _on_day(staged, staged.agg(F.min("file_value")))
        done = load_files(spark, spec, pending, origin=ledger.STAGING, pre_status=pre_status)
        refused += done.refused
        if done.status != "no_files":
            return replace(done, refused=refused)
        if not done.refused:
            return LoadResult("nothing_staged", refused=refused)
        # a day that has only files with other columns holds up none after it
        staged = staged.where(~F.col("file_name").isin(*done.refused))


def load_files(
    spark: SparkSession,
    spec: LoadSpec,
    files: DataFrame,
    origin: str = ledger.INBOUND,
    pre_status: bool = False,
) -> LoadResult:
    """Load the given files whether or not they have been loaded before.

    The table is created if absent. In ``append`` mode rows are added. In ``replace``
    mode the rows of new files are added, too, and the days of files that were loaded
    before, or that an interrupted load had begun, are replaced, each from all its files.
    Counts are observed on the write itself; a file is read once, and once
    more only if some of its rows have to be quarantined. Raises ``ConcurrentLoadError`` while
    another load of the table runs.
    """
    with claimed(spark, spec), listing_in_few_tasks(spark):
        chosen = _snapshot(files)
        if spec.days_per_load is None or not chosen.num_rows:
            return _load_files(spark, spec, chosen, origin, pre_status)
        days = sorted(set(chosen["file_value"].to_pylist()))
        done: list[LoadResult] = []
        for at in range(0, len(days), spec.days_per_load):
            group = pa.array(days[at : at + spec.days_per_load], pa.int32())
            part = chosen.filter(pc.is_in(chosen["file_value"], group))
            done.append(_load_files(spark, spec, part, origin, pre_status and not at))
        return _together(done)


def _together(done: list[LoadResult]) -> LoadResult:
    """The result of a load in groups."""
    lows = [d.min_datestr for d in done if d.min_datestr is not None]
    highs = [d.max_datestr for d in done if d.max_datestr is not None]
    return replace(
        done[0],
        files=tuple(sorted(f for d in done for f in d.files)),
        rows=sum(d.rows for d in done),
        quarantined=sum(d.quarantined for d in done),
        null_keys=sum(d.null_keys for d in done),
        malformed=sum(d.malformed for d in done),
        min_datestr=min(lows, default=None),
        max_datestr=max(highs, default=None),
        days=tuple(sorted({x for d in done for x in d.days})),
        refused=tuple(sorted(f for d in done for f in d.refused)),
    )


def _load_files(
    spark: SparkSession, spec: LoadSpec, chosen: pa.Table, origin: str, pre_status: bool
) -> LoadResult:
    if not chosen.num_rows:
        return LoadResult("no_files")
    created = not table_exists(spark, spec.table)
    redone, begun = chosen.slice(0, 0), set()
    if not created:
        left = ledger.interrupted_files(spark, spec)
        begun = set(left["load_id"].to_pylist())
        if begun and spec.mode == "append":
            names = ", ".join(sorted(set(left["file_name"].to_pylist()))[:3])
            raise ledger.InterruptedLoadError(
                f"a load of {left.num_rows} files died, such as {names}, and its rows may be in "
                "the table; look, and say so with daybook.plans.settle"
            )
        if spec.mode == "replace":
            again = _loaded_days(spark, spec, chosen) | set(left["file_value"].to_pylist())
            redone = _whole_days(spark, spec, chosen, again, origin)
            fresh = pc.invert(pc.is_in(chosen["file_value"], pa.array(again, pa.int32())))
            chosen = chosen.filter(fresh)

    files, names = with_headers(spark, pa.concat_tables([redone, chosen]), spec.options)
    redone, chosen = files.slice(0, redone.num_rows), files.slice(redone.num_rows)
    known = _columns(spark, spec, created, files, names)
    odd = pa.array([h for h, own in names.items() if sorted(own) != sorted(known)], pa.string())
    stuck = redone.filter(pc.is_in(redone["header"], odd))
    if stuck.num_rows:
        raise writes.SchemaMismatchError(
            f"{stuck['path'][0]} belongs to a day that is to be replaced and has the columns "
            f"{names[stuck['header'][0].as_py()]}, not {known}"
        )
    out = chosen.filter(pc.is_in(chosen["header"], odd))
    chosen = chosen.filter(pc.invert(pc.is_in(chosen["header"], odd)))
    refused = tuple(sorted(out["file_name"].to_pylist()))
    if not redone.num_rows and not chosen.num_rows:
        if not created:
            ledger.refuse(spark, spec, out, origin)
        return LoadResult("no_files", refused=refused)

    before: list[Row] = []
    if pre_status and not created:
        before = partition_counts(spark.table(spec.table)).orderBy(DAY).collect()
    batches = [(redone, "replace"), (chosen, "create" if created else "append")]
    batches = [(f, how) for f, how in batches if f.num_rows]
    files = pa.concat_tables([f for f, _ in batches])
    load_id = ledger.start(spark, spec, created, files, origin)
    if out.num_rows:
        ledger.refuse(spark, spec, out, origin)
    seen = [_write(spark, spec, part, how, names, known) for part, how in batches]
    fed = {(x["file"], x["day"]) for line in seen for x in line["foreign"]}
    ledger.finish(spark, spec, _with_days(files, fed), origin, load_id)
    ledger.end(spark, spec, begun)
    ledger.compact(spark, spec)
    status = "created" if created else {"append": "appended", "replace": "replaced"}[spec.mode]
    lows = [line["min_datestr"] for line in seen if line["min_datestr"] is not None]
    highs = [line["max_datestr"] for line in seen if line["max_datestr"] is not None]
    return LoadResult(
        status=status,
        files=tuple(sorted(files["file_name"].to_pylist())),
        rows=sum(line["good"] for line in seen),
        quarantined=sum(line["strays"] for line in seen),
        null_keys=sum(line["null_keys"] for line in seen),
        min_datestr=min(lows, default=None),
        max_datestr=max(highs, default=None),
        malformed=sum(line["malformed"] for line in seen),
        days=tuple(sorted(set(files["file_value"].to_pylist()))),
        refused=refused,
        before=before,
    )


def _columns(
    spark: SparkSession, spec: LoadSpec, created: bool, files: pa.Table, names: dict[str | None, list[str]]
) -> list[str]:
    """The data columns that files need: the table's, or for a new one those of the spec, or
    those that most files have, in the order of the earliest such file."""
    if not created:
        return [c for c in spark.table(spec.table).columns if c != DAY]
    if spec.columns is not None:
        return list(spec.columns)
    held: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(zip(files["path"].to_pylist(), files["header"].to_pylist(), strict=True)):
        held.setdefault(tuple(sorted(names[header])), []).append(header)
    most = max(len(h) for h in held.values())
    often = [h for h in held.values() if len(h) == most]
    if len(often) > 1:
        raise writes.SchemaMismatchError(
            f"as many files have the columns {names[often[0][0]]} as {names[often[1][0]]}; "
            "name the table's with LoadSpec.columns"
        )
    return names[often[0][0]]


def _write(
    spark: SparkSession,
    spec: LoadSpec,
    files: pa.Table,
    how: str,
    names: dict[str | None, list[str]],
    known: list[str],
) -> dict:
    """Write the files' rows one way, and what is left over to the quarantine."""
    batch = _read_batch(spark, spec, files, names, known)
    own_day = _own_day(spec)
    # Observed after the shuffle, if there is one: what the write's own tasks
    # count is counted once, also when a lost executor's shuffle output is redone.
    counts = Observation()
    good = writes.layout(batch, spec).observe(counts, *_metrics(own_day, spec)).where(own_day)
    good = good.drop(SOURCE_FILE, writes.SOURCE_DAY, MALFORMED)
    if how == "create":
        writes.create_table(good, spec)
    elif how == "append":
        writes.append_rows(good, spec)
    else:
        writes.replace_days(good, spec)
    seen = counts.get
    if spec.mode == "replace":
        days, stray_days = set(files["file_value"].to_pylist()), set(seen["stray_days"])
        if how == "replace":
            _clear_emptied(spark, spec, days - set(seen["days"]))
        if how != "append":
            writes.clear_quarantine(spark, spec, days - stray_days)
        if seen["strays"]:
            odd = files.filter(pc.is_in(files["file_value"], pa.array(stray_days, pa.int32())))
            batch = _read_batch(spark, spec, odd, names, known).where(F.col(writes.SOURCE_DAY).isin(*stray_days))
            writes.quarantine(batch.where(~own_day), spec, added=how == "append")
    return seen


def _own_day(spec: LoadSpec) -> Column:
    """Rows that go to the table: in replace mode well-formed ones of their file's day."""
    if spec.mode == "append":
        return F.lit(True)
    own = F.coalesce(F.col(DAY) == F.col(writes.SOURCE_DAY), F.lit(False))
    return own & F.col(MALFORMED).isNull()


def _with_days(files: pa.Table, foreign: set[tuple[str, int]]) -> pa.Table:
    """``files`` with ``fed``: the days their rows went to, their own one always."""
    days: dict[str, set[int]] = {}
    for name, day in foreign:
        days.setdefault(name, set()).add(day)
    names, own = files["file_name"].to_pylist(), files["file_value"].to_pylist()
    fed = [sorted({day, *days.get(name, ())}) for name, day in zip(names, own, strict=True)]
    return files.append_column("fed", pa.array(fed, pa.list_(pa.int32())))


def _snapshot(files: DataFrame) -> pa.Table:
    """The file list as it is now, on the driver, where the scan keeps it as well.

    One snapshot serves the read and the ledger: a file that lands in between
    must not be recorded as loaded.
    """
    with files_in_few_tasks(files.sparkSession):
        return keyed(files).select(*FILE_COLUMNS).toArrow()


def _metrics(good: Column, spec: LoadSpec) -> list[Column]:
    day = F.col(writes.SOURCE_DAY)
    away = F.col(DAY).isNotNull() & ~F.col(DAY).eqNullSafe(day)
    metrics = [
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("strays"),
        F.count_if(F.col(DAY).isNull()).alias("null_keys"),
        F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
        F.min(F.when(good, F.col(DAY))).alias("min_datestr"),
        F.max(F.when(good, F.col(DAY))).alias("max_datestr"),
        # files with rows of other days, and those days
        F.collect_set(
            F.when(good & away, F.struct(F.col(SOURCE_FILE).alias("file"), F.col(DAY).alias("day")))
        ).alias("foreign"),
    ]
    if spec.mode == "replace":  # sets of file days, as many as days are loaded
        metrics.append(F.collect_set(F.when(good, day)).alias("days"))
        metrics.append(F.collect_set(F.when(~good, day)).alias("stray_days"))
    return metrics


def _clear_emptied(spark: SparkSession, spec: LoadSpec, days: set[int]) -> None:
    """Empty the loaded days whose files no longer hold a row of theirs."""
    if days:
        held = {row[DAY] for row in partition_keys(spark, spec.table).collect()}
        writes.clear_days(spark, spec, days & held)


def _read_batch(
    spark: SparkSession,
    spec: LoadSpec,
    files: pa.Table,
    names: dict[str | None, list[str]],
    known: list[str],
) -> DataFrame:
    """The files' rows with the ``known`` columns, matched by name.

    Files of equal headers are one scan, which checks each file's header again. Each row also
    has its file's name and day, and the text of a malformed row; the day of files of one day
    is a literal.
    """
    batch = None
    for header in sorted(pc.unique(files["header"]).to_pylist()):
        paths = files.filter(pc.equal(files["header"], header))["path"].to_pylist()
        rows = read_days(
            spark, [literal(p) for p in paths], spec.day_column, names[header], SOURCE_FILE, MALFORMED, spec.options
        )
        rows = writes.align(rows, [*known, SOURCE_FILE, MALFORMED, DAY])
        batch = rows if batch is None else batch.union(rows)
    days = pc.unique(files["file_value"])
    day = F.lit(days[0].as_py()) if len(days) == 1 else file_key(SOURCE_FILE)
    return batch.withColumn(writes.SOURCE_DAY, day)


def _on_day(files: DataFrame, day: DataFrame) -> DataFrame:
    return files.where(F.col("file_value") == day.scalar())


def _only_latest(files: DataFrame, spec: LoadSpec) -> DataFrame:
    files = keyed(files)
    return _on_day(files, files.agg(F.max("file_value"))) if spec.latest_only else files


def _past_high_water(
    spark: SparkSession, spec: LoadSpec, inbound: DataFrame, loaded: DataFrame
) -> DataFrame:
    """Pending by the table's latest day alone.

    A fetched file counts as an inbound file, although it is read where it lies.
    """
    mark = high_water_mark(partition_keys(spark, spec.table)).first()["high_water"]
    if not spec.latest_only:
        return keyed(inbound) if mark is None else inbound.where(F.col("file_value") > mark)
    fetched = loaded.where(F.col("origin") == ledger.STAGING).select("file_value")
    known = inbound.select("file_value").union(fetched)
    latest = _on_day(keyed(inbound), known.agg(F.max("file_value")))
    return latest if mark is None else latest.where(F.col("file_value") != mark)


def _loaded_days(spark: SparkSession, spec: LoadSpec, chosen: pa.Table) -> set[int]:
    """The days of those of ``chosen`` that have been loaded before."""
    names = ledger.loaded_files(spark, spec).select("file_name")
    known = file_frame(spark, chosen.select(["file_name", "file_value"]))
    days = known.join(names, "file_name", "left_semi").select("file_value").distinct()
    return {row["file_value"] for row in days.collect()}


def _whole_days(
    spark: SparkSession, spec: LoadSpec, chosen: pa.Table, again: set[int], origin: str
) -> pa.Table:
    """All files of the days ``again``: replacing a day needs all of it.

    That is those of ``chosen``, what else lies in the folders loaded from, and what the
    days were loaded from before, wherever it lies.
    """
    if not again:
        return chosen.slice(0, 0)
    folders, others = spec.inbound, spec.staging
    if origin == ledger.STAGING:
        folders, others = others, folders
    days = file_frame(spark, pa.table({"day": pa.array(sorted(again), pa.int32())}))
    on_days = F.col("file_value") == F.col("day")
    lines = ledger.loaded_files(spark, spec).where(F.col("file_name").isNotNull())
    _refuse_shared(lines, days)
    recorded = lines.join(days, on_days, "left_semi").select("file_name").distinct().toArrow()
    chosen = chosen.filter(pc.is_in(chosen["file_value"], pa.array(again, pa.int32())))
    names = file_frame(spark, chosen.select(["file_name"]))
    same_day = (
        list_files(spark, folders)
        .join(days, on_days, "left_semi")
        .join(names, "file_name", "left_anti")
    )
    whole = pa.concat_tables([chosen, _snapshot(same_day)])
    gone = _not_among(spark, recorded, whole)
    for place, below in ((others, False), (spec.archive, True)):
        if gone.num_rows and place is not None:
            elsewhere = list_files(spark, place, below)
            found = elsewhere.join(file_frame(spark, gone), "file_name", "left_semi")
            whole = pa.concat_tables([whole, _snapshot(found)])
            gone = _not_among(spark, gone, whole)
    if gone.num_rows:
        raise IncompleteDayError(
            f"{gone.num_rows} files of the days to replace are gone, such as "
            f"{gone['file_name'][0]}; put them back, or load the new files with mode='append'"
        )
    return whole


def _refuse_shared(lines: DataFrame, days: DataFrame) -> None:
    """A day that holds rows of another day's file would lose them if it were replaced."""
    fed = lines.select("file_name", "file_value", F.explode("fed").alias("day"))
    shared = fed.where("day <> file_value").join(days, "day", "left_semi").take(1)
    if shared:
        raise IncompleteDayError(
            f"day {shared[0]['day']} also holds rows that {shared[0]['file_name']} appended, "
            "which replacing it would lose; load with mode='append'"
        )


def _not_among(spark: SparkSession, names: pa.Table, files: pa.Table) -> pa.Table:
    if not names.num_rows:
        return names
    present = file_frame(spark, files.select(["file_name"]))
    return file_frame(spark, names).join(present, "file_name", "left_anti").toArrow()

"""The ledger: what has been loaded, and what a load that died had begun.

Every load adds a ``started`` line per file before it touches the table and a
``finished`` line per file after table and quarantine are written. Files of a load
that was started but not finished are pending, and what it may have written is
known: in ``replace`` mode their days are loaded anew as a whole; in ``append`` mode
nobody can tell whether the rows are there, so the next load refuses until
``settle`` says it.

Lines are appended as small files. When there are more than ``TAIL_FILES`` of them, a load
that ends folds all lines into a snapshot, so that reading the ledger costs a snapshot and a
short tail however many loads there have been.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans.spec import LoadSpec
from daybook.sources import partition_keys
from daybook.sources.catalogue import content_digests
from daybook.sources.landing import DAY, file_frame, read_if_there
from daybook.workspace import complete_folders, delete_paths

SCHEMA = (
    "file_name string, file_value int, origin string, path string, length long, "
    "modified timestamp, fed array<int>, load_id string, state string, at timestamp, digest string"
)

# Values of ``origin``.
INBOUND = "inbound"
STAGING = "staging"
TABLE = "table"  # a day that was in the table before it had a ledger; no file name

# Values of ``state``. A load that is redone or settled is ended by the last one.
STARTED = "started"
FINISHED = "finished"
ENDED = "ended"
REFUSED = "refused"  # a file with other columns, left out of its load
COVERED = "covered"  # in a snapshot: a file of the tail whose lines it holds

TAIL_FILES = 64
#: Below the ledger's folder; a scan of that folder passes over names like this one.
SNAPSHOTS = "_snapshots"


class InterruptedLoadError(RuntimeError):
    """An earlier load died, and only its user can say whether its rows are there."""


class ChangedFileError(RuntimeError):
    """A file that was loaded has other content now, or another file has its name."""


def _tail(spark: SparkSession, spec: LoadSpec) -> DataFrame | None:
    """The lines in files of their own, also those that a snapshot holds."""
    lines = read_if_there(spark.read.schema(SCHEMA), spec.ledger_path)
    if lines is None:
        return None
    # lines of the time before loads were started
    return lines.withColumn("state", F.coalesce("state", F.lit(FINISHED)))


def _with_snapshot(spark: SparkSession, spec: LoadSpec, tail: DataFrame) -> DataFrame:
    """All lines: the last whole snapshot's, and those of the tail's files that it does not hold."""
    snapshots = complete_folders(spark, f"{spec.ledger_path}/{SNAPSHOTS}")
    if not snapshots:
        return tail
    snapshot = spark.read.schema(SCHEMA).parquet(snapshots[-1])
    held = snapshot.where(F.col("state") == COVERED).select(F.col("file_name").alias("_file"))
    fresh = tail.withColumn("_file", F.col("_metadata.file_name")).join(held, "_file", "left_anti")
    return snapshot.where(F.col("state") != COVERED).union(fresh.select(*tail.columns))


def _written(spark: SparkSession, spec: LoadSpec) -> DataFrame | None:
    tail = _tail(spark, spec)
    return None if tail is None else _with_snapshot(spark, spec, tail)


def _folded(lines: DataFrame) -> DataFrame:
    """What later loads ask of the lines: open loads, and each loaded or refused file once.

    A file that was loaded several times as it is has the days all of those fed.
    """
    over = lines.where(F.col("state").isin(FINISHED, ENDED)).select("load_id")
    begun = lines.where(F.col("state") == STARTED).join(over, "load_id", "left_anti")
    file = [c for c in lines.columns if c not in ("load_id", "fed", "at")]
    kept = lines.where(F.col("state").isin(FINISHED, REFUSED)).groupBy(*file).agg(
        F.max_by("load_id", "at").alias("load_id"),
        F.array_distinct(F.flatten(F.collect_list("fed"))).alias("fed"),
        F.max("at").alias("at"),
    )
    return kept.select(*lines.columns).union(begun.select(*lines.columns))


def compact(spark: SparkSession, spec: LoadSpec, tail_files: int = TAIL_FILES) -> bool:
    """Fold the ledger into a snapshot if its tail has more than ``tail_files`` files.

    The snapshot names the files it holds and counts from the moment its write has ended;
    only then they are deleted, and a file that is left over by a failure is passed over.
    """
    tail = _tail(spark, spec)
    files = [] if tail is None else tail.inputFiles()
    if len(files) <= tail_files:
        return False
    root = f"{spec.ledger_path}/{SNAPSHOTS}"
    before = complete_folders(spark, root)
    number = int(before[-1].rsplit("/", 1)[1]) + 1 if before else 1
    names = pa.table({"file_name": [f.rsplit("/", 1)[1] for f in files]})
    lines = _folded(_with_snapshot(spark, spec, tail))
    lines = lines.union(_line(file_frame(spark, names), state=COVERED))
    lines.hint("rebalance").write.mode("overwrite").parquet(f"{root}/{number:010d}")
    delete_paths(spark, [*files, *before])
    return True


def _day_lines(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """A line per day of a table that has no ledger."""
    return _line(
        partition_keys(spark, spec.table).select(F.col(DAY).alias("file_value")),
        origin=TABLE,
        state=FINISHED,
    )


def _line(files: DataFrame, **values: str | None) -> DataFrame:
    """Lines of the ledger's schema, with columns of ``files``, fixed values and blanks."""
    given = {name: F.lit(value) for name, value in values.items()}
    given["at"] = F.current_timestamp()
    fields = [f.strip().split(" ") for f in SCHEMA.split(",")]
    return files.select(
        *[
            (F.col(name) if name in files.columns else given.get(name, F.lit(None)))
            .cast(kind)
            .alias(name)
            for name, kind in fields
        ]
    )


def loaded_files(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The files of finished loads, or, for a table without a ledger, a line per day."""
    written = _written(spark, spec)
    if written is not None:
        return written.where(F.col("state") == FINISHED)
    return _day_lines(spark, spec)


def interrupted_files(spark: SparkSession, spec: LoadSpec) -> pa.Table:
    """The files of loads that were started and neither finished nor settled."""
    written = _written(spark, spec)
    if written is None:
        return pa.table({k: [] for k in ("load_id", "file_name", "file_value")})
    ended = written.where(F.col("state").isin(FINISHED, ENDED)).select("load_id")
    open_ones = written.where(F.col("state") == STARTED).join(ended, "load_id", "left_anti")
    return open_ones.select("load_id", "file_name", "file_value").toArrow()


def without_loaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not in the ledger, by name, or by day where it has no name."""
    named = ledger.where(F.col("file_name").isNotNull()).select("file_name")
    days = ledger.where(F.col("file_name").isNull()).select("file_value")
    return files.join(named, "file_name", "left_anti").join(days, "file_value", "left_anti")


def _met(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files with the name of a loaded one: ``same`` if it is as long and, where it still lies
    there, as old; ``moved`` if it lies elsewhere, so that its length tells little."""
    known = ledger.where(F.col("length").isNotNull()).select(
        "file_name",
        F.col("path").alias("_path"),
        F.col("length").alias("_length"),
        F.col("modified").alias("_modified"),
        F.col("digest").alias("_digest"),
    )
    here, long = F.col("path") == F.col("_path"), F.col("length") == F.col("_length")
    old = F.col("modified") == F.col("_modified")
    met = files.join(known, "file_name").groupBy(*files.columns).agg(
        F.max(here & long & old).alias("same"),
        F.max(~here & long & F.col("_digest").isNull()).alias("taken"),  # of the time before digests
        F.collect_set(F.when(~here & long, F.col("_digest"))).alias("digests"),
    )
    return met.where(~F.col("same"))


def refuse_changed(spark: SparkSession, spec: LoadSpec, files: DataFrame, ledger: DataFrame) -> None:
    """An error if a file has the name of a loaded one and is not it.

    A file is the loaded one if it is as long and as old at the same place, or if it lies
    elsewhere and its lines are the loaded file's. That is looked up once: the place is then
    noted in the ledger.
    """
    met = _met(files, ledger).toArrow()
    asked = met.filter(pc.and_(pc.invert(met["taken"]), pc.greater(pc.list_value_length(met["digests"]), 0)))
    found = content_digests(spark, asked["path"].to_pylist(), spec.options)
    own = [found[p][1] for p in asked["path"].to_pylist()]
    equal = [d in known for d, known in zip(own, asked["digests"].to_pylist(), strict=True)]
    moved = asked.append_column("digest", pa.array(own, pa.string())).filter(pa.array(equal, pa.bool_()))
    known = pc.or_(met["taken"], pc.is_in(met["path"], moved["path"].combine_chunks()))
    odd = met.filter(pc.invert(known))
    if odd.num_rows:
        names = ", ".join(sorted(odd["path"].to_pylist())[:3])
        raise ChangedFileError(
            f"not the files that were loaded under their names: {names}; give them other "
            "names, or load them again with load_files"
        )
    if moved.num_rows:
        moved = moved.drop_columns(["same", "taken", "digests"])
        _append(_line(file_frame(spark, moved), state=FINISHED), spec)


def refuse(spark: SparkSession, spec: LoadSpec, files: pa.Table, origin: str) -> None:
    """Notes files that are left out for their columns, each once as long as it stays as it is."""
    written = _written(spark, spec)
    lines = _line(file_frame(spark, files), origin=origin, state=REFUSED)
    if written is None:
        lines = lines.union(_day_lines(spark, spec))
    else:
        known = written.where(F.col("state") == REFUSED).select("path", "length", "modified")
        lines = lines.join(known, ["path", "length", "modified"], "left_anti").select(*lines.columns)
        if not lines.take(1):
            return
    _append(lines, spec)


def refused_files(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """Files that loads have left out for their columns: path, length, time, when."""
    written = _written(spark, spec)
    if written is None:
        written = spark.createDataFrame([], SCHEMA)
    refused = written.where(F.col("state") == REFUSED)
    return refused.select("path", "file_name", "file_value", "origin", "length", "modified", "at")


def _append(lines: DataFrame, spec: LoadSpec, mode: str = "append") -> None:
    lines.coalesce(1).write.mode(mode).parquet(spec.ledger_path)


def start(
    spark: SparkSession, spec: LoadSpec, created: bool, files: pa.Table, origin: str
) -> str:
    """Before data is written: note the files. The ledger of an earlier table of that
    place is forgotten; a table without one gets the days it already holds."""
    load_id = uuid.uuid4().hex
    lines = _line(file_frame(spark, files), origin=origin, load_id=load_id, state=STARTED)
    if not created and _written(spark, spec) is None:
        lines = lines.union(_day_lines(spark, spec))
    _append(lines, spec, "overwrite" if created else "append")
    return load_id


def finish(
    spark: SparkSession, spec: LoadSpec, files: pa.Table, origin: str, load_id: str
) -> None:
    """After the data: its files are loaded. ``files`` has the days each one fed."""
    _append(_line(file_frame(spark, files), origin=origin, load_id=load_id, state=FINISHED), spec)


def end(spark: SparkSession, spec: LoadSpec, load_ids: set[str]) -> None:
    """Interrupted loads whose days have been loaded anew, or that were settled."""
    if load_ids:
        ids = file_frame(spark, pa.table({"load_id": sorted(load_ids)}))
        _append(_line(ids, state=ENDED), spec)


def settle(spark: SparkSession, spec: LoadSpec, loaded: bool) -> None:
    """Says of interrupted loads that their rows are in the table, or that they are not
    (any more), so that their files are loaded next time."""
    files = interrupted_files(spark, spec)
    ids = set(files["load_id"].to_pylist())
    if loaded and ids:
        written = _written(spark, spec)
        lines = written.where((F.col("state") == STARTED) & F.col("load_id").isin(*ids))
        _append(lines.withColumns({"state": F.lit(FINISHED), "at": F.current_timestamp()}), spec)
    else:
        end(spark, spec, ids)

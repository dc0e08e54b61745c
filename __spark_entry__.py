"""

``entry`` is the smoke check, ``queries`` holds one entry per operator of

The tables come as Parquet, while the job's input is one CSV per day. The first
query that needs them lays ``events`` out as landing files in the scratch folder,
the last days in ``staging`` and the rest in ``inbound``, and likewise ``orders``;
queries that move or rewrite files lay out their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import LoadSpec, load_files, run
from daybook.functions import file_key
from daybook.operators import (
    already_processed,
    batch_date_range,
    duplicate_profile,
    earliest_file,
    high_water_mark,
    latest_file,
    load_profile,
    loaded_partitions,
    partition_counts,
    pending_files,
    post_load_report,
    preview,
)
from daybook.plans import ChangedFileError, ledger
from daybook.settings import listing_in_few_tasks
from daybook.sources import export_days, list_files, partition_keys, read_days
from daybook.sources.landing import DAY, with_datestr
from daybook.streaming import drain_staged, ingest_new
from daybook.workspace import scratch_folder

try:
    import corpus_pipeline
    from daybook.llm.queries import ORACLE_SQL as LLM_SQL
    from daybook.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "daybook.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}

SMOKE_DIR = "/root/testdata/sf0.001"
STAGED_DAYS = 10
EVENT_TYPES = ["user_id", "event_type"]

_landings: dict[tuple[str, str, str], str] = {}


# --- inputs -----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_datestr(table(spark, sf_dir, "events"), "ts")


def is_landed(rows: DataFrame) -> Column:
    """Not among the last days, which are staged."""
    day = F.col("ts").cast("date")
    return day <= rows.agg(F.date_sub(F.max(day), STAGED_DAYS)).scalar()


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return rows.where(is_landed(rows))


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with ``inbound`` and ``staging`` files of ``events``, made once."""
    rows = table(spark, sf_dir, "events")
    folder = F.when(is_landed(rows), "inbound").otherwise("staging")
    return laid_out(sf_dir, "events", rows, F.col("ts"), folder)


def orders_landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with ``inbound`` files of ``orders``, thousands of days, made once."""
    rows = table(spark, sf_dir, "orders")
    return laid_out(sf_dir, "orders", rows, F.col("o_orderdate"), F.lit("inbound"))


def laid_out(sf_dir: str, name: str, rows: DataFrame, day: Column, folder: Column) -> str:
    spark = rows.sparkSession
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _landings:
        root = scratch_folder(spark, "landing")
        export_days(rows, day, root, folder)
        _landings[slot] = root
    return _landings[slot]


def event_spec(spark: SparkSession, root: str, **settings) -> LoadSpec:
    """A new table fed from the landing files below ``root``."""
    location = scratch_folder(spark, "table")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    spec = LoadSpec(
        table=f"{spark.catalog.currentDatabase()}.{name}",
        location=location,
        inbound=f"{root}/inbound",
        staging=f"{root}/staging",
        day_column="ts",
    )
    return replace(spec, **settings)


def both_folders(root: str) -> list[str]:
    return [f"{root}/inbound", f"{root}/staging"]


def result_of(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The loaded table by its files; its catalog entry goes."""
    schema = spark.table(spec.table).schema
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": spec.table})
    with listing_in_few_tasks(spark):
        return spark.read.schema(schema).format(spec.fmt).load(spec.location)


# --- keys, checks and aggregates over a table -------------------------------


def derive_datestr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", DAY)


def q_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_counts(events(spark, sf_dir))


def q_partition_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_counts(with_datestr(table(spark, sf_dir, "orders"), "o_orderdate"))


def q_load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_profile(events(spark, sf_dir), EVENT_TYPES)


def q_load_profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_profile(with_datestr(table(spark, sf_dir, "lineitem"), "l_shipdate"))


def q_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(events(spark, sf_dir))


def q_loaded_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_partitions(events(spark, sf_dir))


def q_duplicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_profile(events(spark, sf_dir), EVENT_TYPES)


def post_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_load_report(events(spark, sf_dir), EVENT_TYPES)


def file_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("ts").cast("date").cast("string"), F.lit(".csv"))
    names = table(spark, sf_dir, "events").select(name.alias("file_name")).distinct()
    return names.select("file_name", file_key("file_name").alias("file_value"))


# --- landing files ----------------------------------------------------------


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, both_folders(landing(spark, sf_dir))).select("file_name")


def latest_landing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_file(list_files(spark, f"{landing(spark, sf_dir)}/inbound"))


def earliest_staged_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return earliest_file(list_files(spark, f"{landing(spark, sf_dir)}/staging"))


def already_processed_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, both_folders(landing(spark, sf_dir)))
    return already_processed(files, high_water_mark(landed_events(spark, sf_dir)))


def q_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, both_folders(landing(spark, sf_dir)))
    loaded = loaded_partitions(landed_events(spark, sf_dir))
    return pending_files(files, loaded).select("file_name", "file_value")


def csv_scan_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = both_folders(landing(spark, sf_dir))
    columns = table(spark, sf_dir, "events").columns
    return read_days(spark, folders, "ts", columns)


def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the latest file's day, read from the landing files."""
    files = list_files(spark, both_folders(landing(spark, sf_dir)))
    last = files.where(F.col("file_value") == files.agg(F.max("file_value")).scalar())
    paths = [row["path"] for row in last.select("path").collect()]
    return read_days(spark, paths, "ts")


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_batch(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("long"))
    return preview(rows, 2, "event_id").select("event_id", *EVENT_TYPES, DAY)


def q_batch_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_date_range(read_days(spark, both_folders(landing(spark, sf_dir)), "ts"))


# --- loads ------------------------------------------------------------------


def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root))
    run(spark, spec)
    return partition_counts(result_of(spark, spec))


def initial_load_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, latest_only=True, check="high_water", mode="append")
    run(spark, spec)
    return partition_counts(result_of(spark, spec))


def initial_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of small days in one load."""
    root = orders_landing(spark, sf_dir)
    spec = event_spec(spark, root, day_column="o_orderdate", staging=None)
    run(spark, spec)
    return partition_counts(result_of(spark, spec))


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the write itself observed, without another pass."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root))
    done = run(spark, spec)
    result_of(spark, spec)
    return spark.createDataFrame(
        [(done.rows, done.null_keys, done.min_datestr, done.max_datestr)],
        "row_count long, null_keys long, min_datestr int, max_datestr int",
    )


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root))
    run(spark, spec)
    return result_of(spark, spec).withColumn("event_id", F.col("event_id").cast("long"))


def table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's partitions, without a scan."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root))
    run(spark, spec)
    keys = partition_keys(spark, spec.table)
    result_of(spark, spec)
    return keys


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inbound days, then, as they arrive, the others."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, mode="append")
    run(spark, spec)
    run(spark, replace(spec, inbound=both_folders(root)))
    return partition_counts(result_of(spark, spec))


def pre_write_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day ahead of the second load, and the rows it adds."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, mode="append")
    run(spark, spec)
    done = run(spark, replace(spec, inbound=both_folders(root)), pre_status=True)
    result_of(spark, spec)
    lines = [("existing", r[DAY], r["row_count"]) for r in done.before]
    lines.append(("incoming", None, done.rows))
    return spark.createDataFrame(lines, "stage string, datestr int, row_count long")


def already_loaded_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run finds nothing to do; loading the files again by force changes nothing."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root))
    run(spark, spec)
    again = run(spark, spec)
    if again.status != "already_loaded":
        raise RuntimeError(f"expected nothing to load, got {again}")
    load_files(spark, spec, list_files(spark, spec.inbound))
    return partition_counts(result_of(spark, spec))


def already_loaded_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With nothing to load, a run reports on the table as it is."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root))
    run(spark, spec)
    report = run(spark, spec).report
    lines = report.collect()  # a line per day, while the table has its entry
    result_of(spark, spec)
    return spark.createDataFrame(lines, report.schema)


def requested_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inbound days, then one staged day on request."""
    spec = event_spec(spark, landing(spark, sf_dir))
    run(spark, spec)
    run(spark, spec, request_load=True)
    return partition_counts(result_of(spark, spec))


def duplicate_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days appended, then all appended again."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=both_folders(root), mode="append")
    run(spark, spec)
    load_files(spark, spec, list_files(spark, spec.inbound))
    return load_profile(result_of(spark, spec))


def day_contents(rows: DataFrame) -> DataFrame:
    """Per day the rows and sums over every column, by which two swapped columns show."""
    return rows.groupBy(DAY).agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("event_id").cast("long")).alias("event_ids"),
        F.sum(F.col("user_id").cast("long")).alias("user_ids"),
        F.sum(F.length("event_type")).alias("type_chars"),
        F.min("event_type").alias("first_type"),
        F.sum(F.length("props")).alias("props_chars"),
        F.max("props").alias("last_props"),
        F.max("ts").alias("last_ts"),
        F.max(F.col("value").cast("double")).alias("most"),
    )


def incremental_append_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, mode="append")
    run(spark, spec)
    run(spark, replace(spec, inbound=both_folders(root)))
    return day_contents(result_of(spark, spec))


def requested_load_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = event_spec(spark, landing(spark, sf_dir))
    run(spark, spec)
    run(spark, spec, request_load=True)
    return day_contents(result_of(spark, spec))


def split_days(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Landing files of ``events``, several per day."""
    root = scratch_folder(spark, "landing")
    rows = table(spark, sf_dir, "events")
    for part in range(2):
        mine = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part)
        export_days(mine, F.col("ts"), root, F.lit(folder), suffix=f".{part}" if part else "")
    return root


def stream_split_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in several files, of which a micro-batch holds only some."""
    root = split_days(spark, sf_dir, "inbound")
    spec = event_spec(spark, root, staging=None)
    ingest_new(spark, spec, checkpoint=scratch_folder(spark, "stream"), max_files=25)
    return day_contents(result_of(spark, spec))


def drain_split_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the files archived while later ones of their days are still to come."""
    root = split_days(spark, sf_dir, "staging")
    spec = event_spec(spark, root)
    drain_staged(
        spark,
        spec,
        checkpoint=scratch_folder(spark, "stream"),
        archive=scratch_folder(spark, "archive"),
        max_files=25,
    )
    return day_contents(result_of(spark, spec))


def replace_after_mixed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a week each appended, then the same rows by day in replace mode: the days of
    the weeks' own names are theirs, so nothing that was appended may go."""
    root = scratch_folder(spark, "landing")
    rows = table(spark, sf_dir, "events")
    export_days(rows, F.trunc("ts", "week"), root, F.lit("weeks"))
    export_days(rows, F.col("ts"), root, F.lit("inbound"), suffix=".day")
    spec = event_spec(spark, root, inbound=f"{root}/weeks", mode="append")
    run(spark, spec)
    run(spark, replace(spec, inbound=f"{root}/inbound", mode="replace"))
    return partition_counts(result_of(spark, spec))


def interrupted_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with the ledger of a load that died: its files are loaded anew, each row once."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root)
    run(spark, spec)
    every = replace(spec, inbound=both_folders(root))
    files = list_files(spark, every.inbound).where(F.col("file_value").isNotNull()).toArrow()
    ledger.start(spark, every, False, files, ledger.INBOUND)
    run(spark, every)
    return day_contents(result_of(spark, every))


def odd_header_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load among whose files the earliest has other columns: the others are loaded, and
    it is noted in the ledger, here as a day with no rows."""
    root = scratch_folder(spark, "landing")
    rows = table(spark, sf_dir, "events")
    export_days(rows, F.col("ts"), root)
    first = rows.agg(F.min("ts").cast("date")).scalar()
    odd = rows.where(F.col("ts").cast("date") == first).withColumnRenamed("event_type", "kind")
    export_days(odd, F.date_sub(F.col("ts"), 1), root)
    spec = replace(event_spec(spark, root), staging=None)
    run(spark, spec)
    refused = ledger.refused_files(spark, spec).select(F.col("file_value").alias(DAY), F.lit(0).cast("long"))
    return partition_counts(result_of(spark, spec)).union(refused)


def same_name_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the names and lengths of loaded ones in another folder, with other rows: a run
    takes them for what they are, and loading them by hand replaces their days."""
    root = scratch_folder(spark, "landing")
    rows = table(spark, sf_dir, "events")
    export_days(rows, F.col("ts"), root)
    other = rows.withColumn("event_type", F.reverse("event_type"))
    export_days(other, F.col("ts"), root, F.lit("other"))
    spec = replace(event_spec(spark, root), staging=None)
    run(spark, spec)
    elsewhere = replace(spec, inbound=f"{root}/other")
    try:
        run(spark, elsewhere)
    except ChangedFileError:
        load_files(spark, elsewhere, list_files(spark, elsewhere.inbound))
    return result_of(spark, spec).groupBy(DAY, "event_type").agg(F.count("*").alias("row_count"))


def landing_files_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-folders, also of the form ``key=value``, hide no file and add none."""
    root = scratch_folder(spark, "landing")
    rows = table(spark, sf_dir, "events")
    export_days(rows, F.col("ts"), root)
    for folder in ("inbound/y=1", "inbound/old"):
        export_days(rows.limit(1), F.lit("1999-01-01"), root, F.lit(folder))
    return list_files(spark, f"{root}/inbound").select("file_name")


def pending_by_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run would load next: the files that are not in the ledger."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root)
    run(spark, spec)
    loaded = ledger.loaded_files(spark, spec)
    pending = ledger.without_loaded(list_files(spark, both_folders(root)), loaded)
    result_of(spark, spec)
    return pending.select("file_name", "file_value")


def compacted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded files by a ledger that is folded after each of three loads, the last of which
    loads the second one's files again, as staged ones: a line for each file and origin."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root)
    run(spark, spec)
    ledger.compact(spark, spec, 0)
    run(spark, replace(spec, inbound=both_folders(root)))
    ledger.compact(spark, spec, 0)
    load_files(spark, spec, list_files(spark, spec.staging), ledger.STAGING)
    ledger.compact(spark, spec, 0)
    result_of(spark, spec)
    return ledger.loaded_files(spark, spec).groupBy("file_name", "file_value").agg(F.count("*").alias("places"))


def report_on_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the days that the last run loaded."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root)
    run(spark, spec)
    done = run(spark, replace(spec, inbound=both_folders(root)))
    return post_load_report(result_of(spark, spec), days=done.days)


def report_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the whole table after a second load, taken from the profiles kept by the
    report after the first one and from the days that the second one loaded."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root)
    run(spark, spec, report="incremental")
    report = run(spark, replace(spec, inbound=both_folders(root)), report="incremental").report
    result_of(spark, spec)  # the report reads the kept profiles only
    return report


def mixed_days_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a week each, whose rows go to the partitions of their own days."""
    root = scratch_folder(spark, "landing")
    export_days(table(spark, sf_dir, "events"), F.trunc("ts", "week"), root)
    spec = event_spec(spark, root, mode="append", rebalance=True)
    run(spark, spec)
    return partition_counts(result_of(spark, spec))


# --- streams ----------------------------------------------------------------


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inbound and staged files as a stream of new files."""
    root = landing(spark, sf_dir)
    spec = event_spec(spark, root, inbound=f"{root}/{{inbound,staging}}")
    ingest_new(spark, spec, checkpoint=scratch_folder(spark, "stream"))
    return partition_counts(result_of(spark, spec))


def stage_and_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days staged, drained to the table and moved to an archive folder."""
    root = scratch_folder(spark, "landing")
    export_days(table(spark, sf_dir, "events"), F.col("ts"), root, F.lit("staging"))
    spec = event_spec(spark, root)
    drain_staged(
        spark,
        spec,
        checkpoint=scratch_folder(spark, "stream"),
        archive=scratch_folder(spark, "archive"),
    )
    return partition_counts(result_of(spark, spec))


# --- contract ---------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the post-load report over ``events``."""
    return post_validation_report(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "derive_datestr": derive_datestr,
        "partition_counts": q_partition_counts,
        "partition_counts_orders": q_partition_counts_orders,
        "load_profile": q_load_profile,
        "load_profile_lineitem": q_load_profile_lineitem,
        "high_water_mark": q_high_water_mark,
        "loaded_partitions": q_loaded_partitions,
        "duplicate_profile": q_duplicate_profile,
        "post_validation_report": post_validation_report,
        "file_date_key": file_date_key,
        "landing_files": landing_files,
        "latest_landing_file": latest_landing_file,
        "earliest_staged_file": earliest_staged_file,
        "already_processed_flag": already_processed_flag,
        "pending_files": q_pending_files,
        "csv_scan_all_string": csv_scan_all_string,
        "preview_rows": preview_rows,
        "batch_date_range": q_batch_date_range,
        "initial_load": initial_load,
        "initial_load_latest": initial_load_latest,
        "initial_load_orders": initial_load_orders,
        "load_metrics": load_metrics,
        "table_scan": table_scan,
        "table_partitions": table_partitions,
        "incremental_append": incremental_append,
        "pre_write_status": pre_write_status,
        "already_loaded_noop": already_loaded_noop,
        "already_loaded_report": already_loaded_report,
        "requested_load": requested_load,
        "duplicate_append": duplicate_append,
        "mixed_days_append": mixed_days_append,
        "incremental_append_contents": incremental_append_contents,
        "requested_load_contents": requested_load_contents,
        "stream_split_days": stream_split_days,
        "drain_split_days": drain_split_days,
        "replace_after_mixed_append": replace_after_mixed_append,
        "interrupted_load": interrupted_load,
        "odd_header_load": odd_header_load,
        "same_name_load": same_name_load,
        "landing_files_nested": landing_files_nested,
        "pending_by_ledger": pending_by_ledger,
        "compacted_ledger": compacted_ledger,
        "report_on_days": report_on_days,
        "report_by_changes": report_by_changes,
        "stream_ingest": stream_ingest,
        "stage_and_archive": stage_and_archive,
        **LLM_QUERIES,
    }


_DS = "CAST(strftime(ts, '%Y%m%d') AS INTEGER)"
_FN = "strftime(ts, '%Y-%m-%d') || '.csv'"
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_CUT = f"(SELECT max(CAST(ts AS DATE)) - {STAGED_DAYS} FROM events)"
_LANDED = f"CAST(ts AS DATE) <= {_CUT}"
_STAGED = f"CAST(ts AS DATE) > {_CUT}"
_COUNTS = f"SELECT {_DS} AS datestr, count(*) AS row_count FROM events"
_ALL_COUNTS = f"{_COUNTS} GROUP BY 1"
_CONTENTS = f"""
    SELECT {_DS} AS datestr, count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS event_ids,
           CAST(sum(user_id) AS BIGINT) AS user_ids,
           CAST(sum(length(event_type)) AS BIGINT) AS type_chars, min(event_type) AS first_type,
           CAST(sum(length(props)) AS BIGINT) AS props_chars, max(props) AS last_props,
           max({_TS}) AS last_ts, max(value) AS most
    FROM events"""
_ORDER_COUNTS = """
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS datestr, count(*) AS row_count
    FROM orders GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL."""
    return {
        "derive_datestr": f"SELECT event_id, {_DS} AS datestr FROM events",
        "partition_counts": _ALL_COUNTS,
        "partition_counts_orders": _ORDER_COUNTS,
        "load_profile": f"""
            SELECT count(*) AS total_rows,
                   (SELECT count(*) FROM
                      (SELECT DISTINCT {_DS}, user_id, event_type FROM events)) AS unique_rows
            FROM events""",
        "load_profile_lineitem": """
            SELECT count(*) AS total_rows,
                   (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS unique_rows
            FROM lineitem""",
        "high_water_mark": f"SELECT max({_DS}) AS high_water FROM events",
        "loaded_partitions": f"SELECT DISTINCT {_DS} AS datestr FROM events",
        "duplicate_profile": f"""
            SELECT datestr, CAST(sum(copies - 1) AS BIGINT) AS surplus_rows
            FROM (SELECT {_DS} AS datestr, user_id, event_type, count(*) AS copies
                  FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1)
            GROUP BY 1""",
        "post_validation_report": f"""
            SELECT 'rows' AS metric, {_DS} AS datestr, count(*) AS value
            FROM events GROUP BY 2
            UNION ALL SELECT 'total', NULL, count(*) FROM events
            UNION ALL SELECT 'unique', NULL, count(*)
            FROM (SELECT DISTINCT {_DS}, user_id, event_type FROM events)""",
        "file_date_key": f"SELECT DISTINCT {_FN} AS file_name, {_DS} AS file_value FROM events",
        "landing_files": f"SELECT DISTINCT {_FN} AS file_name FROM events",
        "latest_landing_file": f"SELECT max({_FN}) AS latest_file FROM events WHERE {_LANDED}",
        "earliest_staged_file": f"SELECT min({_FN}) AS next_file FROM events WHERE {_STAGED}",
        "already_processed_flag": f"""
            SELECT DISTINCT {_FN} AS file_name, {_DS} AS file_value,
                   {_DS} = (SELECT max({_DS}) FROM events WHERE {_LANDED}) AS already_processed
            FROM events""",
        "pending_files": f"""
            SELECT DISTINCT {_FN} AS file_name, {_DS} AS file_value
            FROM events WHERE {_STAGED}""",
        "csv_scan_all_string": f"""
            SELECT CAST(event_id AS VARCHAR) AS event_id, {_TS} AS ts,
                   CAST(user_id AS VARCHAR) AS user_id, event_type,
                   CAST(value AS VARCHAR) AS value, props, {_DS} AS datestr
            FROM events""",
        "preview_rows": f"""
            SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, {_DS} AS datestr
            FROM events WHERE {_DS} = (SELECT max({_DS}) FROM events)
            ORDER BY event_id LIMIT 2""",
        "batch_date_range": f"""
            SELECT min({_DS}) AS min_datestr, max({_DS}) AS max_datestr,
                   count(DISTINCT {_DS}) AS dates
            FROM events""",
        "initial_load": _ALL_COUNTS,
        "initial_load_latest": f"""
            {_COUNTS} WHERE CAST(ts AS DATE) =
              (SELECT max(CAST(ts AS DATE)) FROM events WHERE {_LANDED})
            GROUP BY 1""",
        "initial_load_orders": _ORDER_COUNTS,
        "load_metrics": f"""
            SELECT count(*) AS row_count, count(*) - count(ts) AS null_keys,
                   min({_DS}) AS min_datestr, max({_DS}) AS max_datestr
            FROM events""",
        "table_scan": f"""
            SELECT event_id, {_TS} AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type,
                   CAST(value AS VARCHAR) AS value, props, {_DS} AS datestr
            FROM events""",
        "table_partitions": f"SELECT DISTINCT {_DS} AS datestr FROM events",
        "incremental_append": _ALL_COUNTS,
        "pre_write_status": f"""
            SELECT 'existing' AS stage, {_DS} AS datestr, count(*) AS row_count
            FROM events WHERE {_LANDED} GROUP BY 2
            UNION ALL SELECT 'incoming', NULL, count(*) FROM events WHERE {_STAGED}""",
        "already_loaded_noop": _ALL_COUNTS,
        "already_loaded_report": f"""
            SELECT 'rows' AS metric, {_DS} AS datestr, count(*) AS value
            FROM events GROUP BY 2
            UNION ALL SELECT 'total', NULL, count(*) FROM events
            UNION ALL SELECT 'unique', NULL, count(*) FROM (SELECT DISTINCT * FROM events)""",
        "requested_load": f"""
            {_COUNTS} WHERE {_LANDED} OR CAST(ts AS DATE) =
              (SELECT min(CAST(ts AS DATE)) FROM events WHERE {_STAGED})
            GROUP BY 1""",
        "duplicate_append": """
            SELECT 2 * count(*) AS total_rows, count(*) AS unique_rows
            FROM (SELECT DISTINCT * FROM events)""",
        "mixed_days_append": _ALL_COUNTS,
        "incremental_append_contents": f"{_CONTENTS} GROUP BY 1",
        "requested_load_contents": f"""
            {_CONTENTS} WHERE {_LANDED} OR CAST(ts AS DATE) =
              (SELECT min(CAST(ts AS DATE)) FROM events WHERE {_STAGED})
            GROUP BY 1""",
        "stream_split_days": f"{_CONTENTS} GROUP BY 1",
        "drain_split_days": f"{_CONTENTS} GROUP BY 1",
        "replace_after_mixed_append": f"""
            SELECT {_DS} AS datestr, 2 * count(*) AS row_count FROM events GROUP BY 1""",
        "interrupted_load": f"{_CONTENTS} GROUP BY 1",
        "odd_header_load": f"""
            SELECT {_DS} AS datestr, count(*) AS row_count FROM events GROUP BY 1
            UNION ALL SELECT CAST(strftime(min(ts) - INTERVAL 1 DAY, '%Y%m%d') AS INTEGER), 0 FROM events""",
        "same_name_load": f"""
            SELECT {_DS} AS datestr, reverse(event_type) AS event_type, count(*) AS row_count
            FROM events GROUP BY 1, 2""",
        "landing_files_nested": f"SELECT DISTINCT {_FN} AS file_name FROM events",
        "pending_by_ledger": f"""
            SELECT DISTINCT {_FN} AS file_name, {_DS} AS file_value
            FROM events WHERE {_STAGED}""",
        "compacted_ledger": f"""
            SELECT DISTINCT {_FN} AS file_name, {_DS} AS file_value, 1 + ({_STAGED})::INT::BIGINT AS places
            FROM events""",
        "report_on_days": f"""
            SELECT 'rows' AS metric, {_DS} AS datestr, count(*) AS value
            FROM events WHERE {_STAGED} GROUP BY 2
            UNION ALL SELECT 'total', NULL, count(*) FROM events WHERE {_STAGED}
            UNION ALL SELECT 'unique', NULL, count(*)
            FROM (SELECT DISTINCT * FROM events WHERE {_STAGED})""",
        "report_by_changes": f"""
            SELECT 'rows' AS metric, {_DS} AS datestr, count(*) AS value
            FROM events GROUP BY 2
            UNION ALL SELECT 'total', NULL, count(*) FROM events
            UNION ALL SELECT 'unique', NULL, count(*) FROM (SELECT DISTINCT * FROM events)""",
        "stream_ingest": _ALL_COUNTS,
        "stage_and_archive": _ALL_COUNTS,
        **LLM_SQL,
    }

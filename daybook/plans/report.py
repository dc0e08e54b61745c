"""The report on a whole table, in which only days whose files changed are read.

A day's profile, its rows and unique rows, is kept next to the table with a digest of the
files it was taken from. Files of a table are written under new names and never changed, so
a day with the digest of its profile still holds the same rows, whoever wrote the table.
"""

from __future__ import annotations

import uuid

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.profile import day_profile, report_of
from daybook.plans.spec import LoadSpec
from daybook.settings import listing_in_few_tasks
from daybook.sources.landing import ALL_BELOW, DAY, describe_files, file_frame, read_if_there
from daybook.sources.tables import partition_keys
from daybook.workspace import complete_folders, delete_paths

SCHEMA = f"{DAY} int, digest string, row_count long, unique_rows long"
KEPT_SNAPSHOTS = 2
"""The newest, and the one before it, which a report may still be reading."""


def day_digests(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """(datestr, digest) of the days in the catalog that have files: an order-free digest of
    the files' paths, lengths and times. The files are listed, not opened."""
    days = partition_keys(spark, spec.table, with_null=True).select(F.col(DAY).alias("_day"))
    with listing_in_few_tasks(spark):
        raw = read_if_there(spark.read.format("binaryFile").options(**ALL_BELOW), spec.location)
    if raw is None:
        return days.select(F.col("_day").alias(DAY), F.lit("").alias("digest")).where("false")
    files = describe_files(raw)
    name = F.regexp_extract("path", rf"/{DAY}=([^/]+)/[^/]+\z", 1)
    sums = [
        F.sum(F.xxhash64(F.lit(k), "path", "length", "modified").cast("decimal(38,0)")) for k in range(2)
    ]
    found = files.where(name != "").groupBy(name.try_cast("int").alias(DAY))
    digests = found.agg(F.concat_ws(":", F.count("*"), *sums).alias("digest"))
    return digests.join(days, F.col(DAY).eqNullSafe(F.col("_day")), "left_semi")


def incremental_report(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """``post_load_report`` of the whole table, as of now.

    Only days without a profile for the files they have now are read, and their profiles are
    kept for the next report. The driver holds a line per day. Rows without a day are a day of
    their own; an empty table has the two zero lines.
    """
    digests = day_digests(spark, spec)
    # Listed before the table is read: if a file comes in between, the profile is kept under
    # a digest that no later listing has.
    spark.catalog.refreshTable(spec.table)
    snapshots = complete_folders(spark, spec.profile_path)
    kept = spark.read.schema(SCHEMA).parquet(snapshots[-1]) if snapshots else spark.createDataFrame([], SCHEMA)
    same = (F.col("now.digest") == F.col("kept.digest")) & F.col(f"now.{DAY}").eqNullSafe(F.col(f"kept.{DAY}"))
    joined = digests.alias("now").join(kept.alias("kept"), same, "left")
    lines = joined.select("now.*", "row_count", "unique_rows").toArrow()
    missing = pc.is_null(lines["row_count"])
    changed, current = lines.filter(missing), lines.filter(pc.invert(missing))
    if snapshots and not changed.num_rows and current.num_rows == kept.count():
        return report_of(kept.drop("digest"))

    days = changed[DAY].to_pylist()
    wanted = F.col(DAY).isin(*[d for d in days if d is not None])
    if None in days:
        wanted = wanted | F.col(DAY).isNull()
    fresh = day_profile(spark.table(spec.table).where(wanted)).alias("fresh")
    of = file_frame(spark, changed.select([DAY, "digest"])).alias("of")
    fresh = fresh.join(of, F.col(f"fresh.{DAY}").eqNullSafe(F.col(f"of.{DAY}")))
    fresh = fresh.select(f"fresh.{DAY}", "digest", "row_count", "unique_rows")
    path = f"{spec.profile_path}/{len(snapshots) and _number(snapshots[-1]) + 1:012d}-{uuid.uuid4().hex}"
    file_frame(spark, current).union(fresh).coalesce(1).write.parquet(path)
    delete_paths(spark, [*snapshots, path][:-KEPT_SNAPSHOTS])
    return report_of(spark.read.schema(SCHEMA).parquet(path).drop("digest"))


def _number(snapshot: str) -> int:
    return int(snapshot.rsplit("/", 1)[1].split("-")[0])

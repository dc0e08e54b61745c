"""The three ways rows get into the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans.spec import LoadSpec
from daybook.settings import setting
from daybook.sources.landing import DAY
from daybook.workspace import delete_paths

SOURCE_DAY = "_source_day"


class SchemaMismatchError(ValueError):
    """A batch has not the table's columns."""


def align(batch: DataFrame, columns: list[str]) -> DataFrame:
    """The batch in the table's column order: ``insertInto`` goes by position."""
    missing = [c for c in columns if c not in batch.columns]
    extra = [c for c in batch.columns if c not in columns]
    if missing or extra:
        raise SchemaMismatchError(f"missing columns {missing}, unknown columns {extra}")
    return batch.select(*columns)


def layout(batch: DataFrame, spec: LoadSpec) -> DataFrame:
    """With ``rebalance``, rows shuffled by day; adaptive execution splits large days."""
    return batch.hint("rebalance", F.col(DAY)) if spec.rebalance else batch


def create_table(batch: DataFrame, spec: LoadSpec) -> None:
    """A new external table, partitioned by day."""
    (
        batch.write.format(spec.fmt)
        .mode("overwrite")
        .partitionBy(DAY)
        .option("path", spec.location)
        .saveAsTable(spec.table)
    )


def append_rows(batch: DataFrame, spec: LoadSpec) -> None:
    """Add rows to an existing table."""
    batch.write.insertInto(spec.table)


def replace_days(batch: DataFrame, spec: LoadSpec) -> None:
    """Replace exactly the days the batch holds in an existing table.

    ``insertInto`` ignores the writer's own partitionOverwriteMode option and
    would empty the whole table, so the mode is set on the session.
    """
    with setting(batch.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        batch.write.mode("overwrite").insertInto(spec.table)


def clear_days(spark: SparkSession, spec: LoadSpec, days: set[int]) -> None:
    """Replace days by nothing: a dynamic overwrite leaves days without rows alone.

    No Spark job, however many days. Files go before the catalog's entries, so that a day
    whose entry is gone has no rows that could come back with a new one.
    """
    if days:
        delete_paths(spark, [f"{spec.location.rstrip('/')}/{DAY}={day:d}" for day in days])
        parts = ", ".join(f"PARTITION ({DAY} = {day:d})" for day in sorted(days))
        name = {"name": spec.table}
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS {parts}", args=name)


def quarantine(strays: DataFrame, spec: LoadSpec, added: bool = False) -> None:
    """Keep rows that do not belong to their file's day, by file day, replaceable too.

    ``added`` to those that are kept of other files of their days, or in their place.
    """
    (
        strays.write.mode("append" if added else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SOURCE_DAY)
        .parquet(spec.quarantine_path)
    )


def clear_quarantine(spark: SparkSession, spec: LoadSpec, days: set[int]) -> None:
    """Forget the rows kept from earlier loads of days that have none to keep now."""
    paths = [f"{spec.quarantine_path}/{SOURCE_DAY}={day:d}" for day in days]
    delete_paths(spark, paths, within=spec.quarantine_path)

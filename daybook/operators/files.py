"""Checks over file lists (``file_name``, ``file_value``, ...).

Files whose name carries no day key are never chosen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.sources.landing import DAY


def keyed(files: DataFrame) -> DataFrame:
    return files.where(F.col("file_value").isNotNull())


def latest_file(files: DataFrame) -> DataFrame:
    """Greatest file name, as one row."""
    return keyed(files).agg(F.max("file_name").alias("latest_file"))


def earliest_file(files: DataFrame) -> DataFrame:
    """Smallest file name, the next to fetch, as one row."""
    return keyed(files).agg(F.min("file_name").alias("next_file"))


def already_processed(files: DataFrame, high_water: DataFrame) -> DataFrame:
    """Flag the files whose key equals the high-water mark.

    ``high_water`` is the one-row result of ``high_water_mark``; it is a scalar
    subquery, run once. Without a mark nothing counts as processed.
    """
    mark = high_water.scalar()
    return keyed(files).select(
        "file_name",
        "file_value",
        F.coalesce(F.col("file_value") == mark, F.lit(False)).alias("already_processed"),
    )


def pending_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose key is not among ``loaded`` days, late ones included."""
    days = loaded.select(F.col(DAY).alias("file_value"))
    return keyed(files).join(days, "file_value", "left_anti")

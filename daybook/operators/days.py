"""Aggregates over the day key of a table or batch.

All of them combine map-side first, so what is shuffled is at most one row per
day and task, however uneven the days are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.sources.landing import DAY


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per day. On a partitioned table no data column is read."""
    return df.groupBy(DAY).agg(F.count("*").alias("row_count"))


def loaded_partitions(df: DataFrame) -> DataFrame:
    """The days that occur."""
    return df.select(DAY).distinct()


def high_water_mark(df: DataFrame) -> DataFrame:
    """The latest day; NULL keys do not count, and no rows give NULL."""
    return df.agg(F.max(DAY).alias("high_water"))


def batch_date_range(df: DataFrame) -> DataFrame:
    """First day, last day and number of days of a batch, in one row."""
    days = df.groupBy(DAY).agg(F.lit(1).alias("seen"))
    return days.agg(
        F.min(DAY).alias("min_datestr"),
        F.max(DAY).alias("max_datestr"),
        F.count(DAY).alias("dates"),
    )


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """First ``n`` rows by ``order_by``: a top-n per task, then of those."""
    return df.orderBy(*order_by).limit(n)

"""Total rows against unique rows, by which a repeated load shows.

Everything here is one scan and one large shuffle: equal rows are counted
together, which combines map-side, so a row repeated a billion times sends one
count per task. Rows are compared on whole columns, NULL equal to NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.sources.landing import DAY


def day_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per day: rows and unique rows over ``columns`` (default all).

    ``datestr`` always belongs to the compared columns, so unique rows of
    different days add up.
    """
    columns = [c for c in (columns or df.columns) if c != DAY]
    copies = df.groupBy(DAY, *columns).agg(F.count("*").alias("copies"))
    return copies.groupBy(DAY).agg(
        F.sum("copies").alias("row_count"), F.count("*").alias("unique_rows")
    )


def load_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Total and unique rows, as one row."""
    days = day_profile(df, columns)
    return days.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("unique_rows"), F.lit(0)).alias("unique_rows"),
    )


def duplicate_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Days with repeated rows and how many rows are surplus."""
    surplus = F.col("row_count") - F.col("unique_rows")
    return (
        day_profile(df, columns)
        .select(DAY, surplus.alias("surplus_rows"))
        .where("surplus_rows > 0")
    )


def post_load_report(
    df: DataFrame, columns: Sequence[str] | None = None, days: Sequence[int] | None = None
) -> DataFrame:
    """(metric, datestr, value): rows per day, then total and unique rows.

    ``days`` restricts it; of a partitioned table only their partitions are read.
    The rollup runs over the per-day result, so the table is read once. A rollup
    of no rows has no grand total; the zero lines put it there for an empty table.
    """
    if days is not None:
        df = df.where(F.col(DAY).isin(*days))
    return report_of(day_profile(df, columns))


def report_of(profile: DataFrame) -> DataFrame:
    """The report's lines of a ``day_profile``."""
    rolled = profile.rollup(DAY).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("unique_rows").alias("unique_rows"),
        F.grouping(DAY).alias("overall"),
    )
    totals = _lines(("total", F.col("row_count")), ("unique", F.col("unique_rows")))
    per_day = _lines(("rows", F.col("row_count")))
    report = rolled.select(F.inline(F.when(F.col("overall") == 1, totals).otherwise(per_day)))
    nothing = F.lit(0).cast("long")
    zeros = profile.sparkSession.range(1).select(
        F.inline(_lines(("total", nothing), ("unique", nothing), day=F.lit(None).cast("int")))
    )
    return report.union(zeros).groupBy("metric", DAY).agg(F.sum("value").alias("value"))


def _lines(*metrics: tuple[str, Column], day: Column | None = None) -> Column:
    day = F.col(DAY) if day is None else day
    return F.array(
        *(
            F.struct(F.lit(name).alias("metric"), day.alias(DAY), value.alias("value"))
            for name, value in metrics
        )
    )

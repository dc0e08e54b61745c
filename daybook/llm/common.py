"""Helpers that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.workspace import scratch_folder

BROADCAST_ROWS = 500_000
"""Narrow rows that are broadcast at most; more are joined by a shuffle."""
ROWS_PER_TASK = 20_000
"""How many narrow rows a window partition should hold at most."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read from there.

    This cuts the lineage: work done once survives lost executors.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def if_small(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``rows``, a saved table, marked for broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= (BROADCAST_ROWS if most is None else most) else rows


def given(df: DataFrame, without: list[str] | None = None, **columns: Column) -> DataFrame:
    """``df`` in one column ``given``, so that its names cannot clash with others, and
    ``columns``. ``select("given.*")`` brings it back; columns named in ``without`` go."""
    kept = df.drop(*(without or []))
    whole = F.struct(*[df[f"`{c}`"] for c in kept.columns])
    return df.select(whole.alias("given"), *[c.alias(name) for name, c in columns.items()])


def unit(key: Column) -> Column:
    """A number from [0, 1) out of a 64-bit hash: its upper 53 bits."""
    return F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(1 << 53))


def slice_bits(rows: int) -> int:
    """Bits of a random key that split ``rows`` into slices of ``ROWS_PER_TASK`` or fewer."""
    return max(1, math.ceil(math.log2(max(2.0, rows / ROWS_PER_TASK))) + 1)


def with_running_total(
    rows: DataFrame, groups: list[str], key: str, ties: list[str], weight: Column, bits: int, name: str
) -> DataFrame:
    """Adds ``name``, the sum of ``weight`` over the rows of the group before this one, in the
    order of the 64-bit random ``key``, then ``ties``.

    A group may hold most of all rows: it is cut by the upper ``bits`` of the key, every slice
    is summed on its own, and the slices' sums are added up over one row per slice.
    """
    cut = rows.withColumn("_slice", F.shiftrightunsigned(key, 64 - bits)).withColumn("_weight", weight)
    sums = cut.groupBy(*groups, "_slice").agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(g).alias(f"_of_{g}") for g in groups],
        F.col("_slice").alias("_of_slice"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
    )
    inside = (
        Window.partitionBy(*groups, "_slice")
        .orderBy(key, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups]
    same.append(F.col("_slice") == F.col("_of_slice"))
    ran = cut.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return (
        ran.join(sums, same)
        .withColumn(name, (F.col("_base") + F.col("_inside")).cast("long"))
        .drop("_slice", "_weight", "_inside", "_base", "_of_slice", *[f"_of_{g}" for g in groups])
    )


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row, null and empty apart; map columns do not count."""
    columns = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    parts = [x for c in columns for x in (df[f"`{c}`"].isNull(), df[f"`{c}`"])]
    return [F.xxhash64(F.lit(k), *parts) for k in range(2)]

"""Lay a table out as daily landing files.

The job's input is one header CSV per day. Tables that arrive in another format
take that form here, so every load can run over them.
"""

from __future__ import annotations

import uuid
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.settings import files_in_few_tasks, listing_in_few_tasks

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def export_days(
    df: DataFrame, day: Column, root: str, folder: Column | None = None, suffix: str = ""
) -> None:
    """Write ``df`` to ``root/<folder>/<yyyy-MM-dd><suffix>.csv``, one file per day.

    A tool to lay out test input: the driver renames the files one by one.

    REBALANCE lets adaptive execution split a day that is too large for one task
    and pack small days together; a split day becomes ``<day>.csv``,
    ``<day>.1.csv``, ... Spark names its own output files, so each is moved to
    its landing name afterwards; only file names pass through the driver.
    """
    spark = df.sparkSession
    parts = f"{root}/_parts-{uuid.uuid4().hex}"
    (
        df.withColumn("_folder", folder if folder is not None else F.lit("inbound"))
        .withColumn("_day", day.cast("date").cast("string"))
        .hint("rebalance", F.col("_folder"), F.col("_day"))
        .write.partitionBy("_folder", "_day")
        .option("header", True)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(parts)
    )
    with listing_in_few_tasks(spark), files_in_few_tasks(spark):
        written = (
            spark.read.format("binaryFile")
            .load(parts)
            .select("path", "_folder", F.col("_day").cast("string").alias("_day"))
            .orderBy("path")
            .collect()
        )
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in {row["_folder"] for row in written}:
        fs.mkdirs(hadoop.Path(base, name))

    seen: dict[tuple[str, str], int] = {}
    moves = []
    for row in written:
        slot = (row["_folder"], row["_day"])
        number = seen[slot] = seen.get(slot, -1) + 1
        end = f"{suffix}.{number}.csv" if number else f"{suffix}.csv"
        moves.append((row["path"], f"{root}/{row['_folder']}/{row['_day']}{end}"))

    def move(pair: tuple[str, str]) -> None:
        if not fs.rename(hadoop.Path(pair[0]), hadoop.Path(pair[1])):
            raise OSError(f"could not move {pair[0]} to {pair[1]}")

    with ThreadPool(8) as pool:
        pool.map(move, moves)

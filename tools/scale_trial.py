"""Time the load and the report on copies of ``events``, a third of it on one day.

    python tools/scale_trial.py [--copies 100] [--sf DIR] SCRATCH

Each step is timed next to the step-by-step form of the same work: a job that
previews, counts, peeks and writes as separate actions, and a report of three
separate queries. SCRATCH must be a new folder.
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daybook import LoadSpec, load_files, run  # noqa: E402
from daybook.operators import high_water_mark, post_load_report  # noqa: E402
from daybook.sources import export_days, list_files, partition_keys, read_days  # noqa: E402

HOT_DAY = "2024-01-30"


def skewed(events: DataFrame, copies: int) -> DataFrame:
    """``copies`` of every event under new ids; each third one moves to one day."""
    rows = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    rows = rows.withColumn("event_id", F.col("event_id") * copies + F.col("copy")).drop("copy")
    moved = F.expr(
        f"timestamp_ntz'{HOT_DAY} 00:00:00' + make_dt_interval(0, hour(ts), minute(ts), second(ts))"
    )
    return rows.withColumn("ts", F.when(F.col("event_id") % 3 == 0, moved).otherwise(F.col("ts")))


def timed(label: str, action):
    began = time.perf_counter()
    result = action()
    print(f"{time.perf_counter() - began:8.2f}s  {label}", flush=True)
    return result


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--copies", type=int, default=100)
    parser.add_argument("--sf", default="/root/testdata/sf0.1")
    parser.add_argument("scratch")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.warehouse.dir", f"{args.scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{args.sf}/events.parquet")
    rows = skewed(events.repartition(32), args.copies)
    timed("lay out landing files", lambda: export_days(rows, F.col("ts"), args.scratch))
    inbound = f"{args.scratch}/inbound"
    sizes = list_files(spark, inbound).agg(
        F.count("*"), F.sum("length") / 1e6, F.max("length") / 1e6
    )
    print("          {} files, {:.0f} MB, largest {:.0f} MB".format(*sizes.first()))

    def spec(name: str, **settings) -> LoadSpec:
        where = {"table": f"default.{name}", "location": f"{args.scratch}/{name}"}
        return LoadSpec(**{**where, "inbound": inbound, "day_column": "ts", **settings})

    def copy(name: str) -> None:
        batch = read_days(spark, inbound, "ts", events.columns)
        batch.write.partitionBy("datestr").parquet(f"{args.scratch}/{name}")

    for turn in (1, 2):
        print(f"turn {turn}")
        timed("plain partitioned copy of all files", lambda: copy(f"copy{turn}"))
        replaced = spec(f"replaced{turn}")
        timed("first load of all files, replace mode", lambda: run(spark, replaced))
        timed("the same again by force", lambda: load_files(spark, replaced, list_files(spark, inbound)))
        timed("nothing to load", lambda: run(spark, replaced))
        appended = spec(f"appended{turn}", mode="append")
        timed("first load of all files, append mode", lambda: run(spark, appended))
        shuffled = spec(f"shuffled{turn}", mode="append", rebalance=True)
        timed("the same with rebalance", lambda: run(spark, shuffled))

        table = spark.table(replaced.table)
        hot = list_files(spark, inbound).where(
            F.col("file_value") == int(HOT_DAY.replace("-", ""))
        )
        paths = [r["path"] for r in hot.collect()]

        def step_by_step() -> None:
            batch = read_days(spark, paths, "ts")
            batch.limit(2).collect()
            table.select("datestr").distinct().sort(F.desc("datestr")).first()
            table.groupBy("datestr").count().collect()
            batch.count()
            batch.select("datestr").limit(1).first()
            batch.write.insertInto(appended.table)

        timed("append the hot day, step by step", step_by_step)
        timed("append the hot day", lambda: load_files(spark, appended, hot))

        def three_queries() -> None:
            table.groupBy("datestr").count().collect()
            table.count()
            table.distinct().count()

        timed("report, three queries", three_queries)
        timed("report", lambda: post_load_report(table).collect())
        timed(
            "latest day by sorting distinct days",
            lambda: table.select("datestr").distinct().sort(F.desc("datestr")).first(),
        )
        timed("latest day by max", lambda: high_water_mark(table).first())
        timed(
            "latest day from the catalog",
            lambda: high_water_mark(partition_keys(spark, replaced.table)).first(),
        )
    spark.stop()


if __name__ == "__main__":
    main()

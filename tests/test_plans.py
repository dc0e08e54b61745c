"""What the plans must and must not do at scale."""

import re

import pytest
from conftest import invoice
from pyspark.sql import functions as F

from daybook import load_files, run
from daybook.operators import (
    already_processed,
    high_water_mark,
    load_profile,
    partition_counts,
    post_load_report,
)
from daybook.sources import list_files, partition_keys


def plan(frame):
    return frame._jdf.queryExecution().toString()


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def loaded(spark, shop):
    shop.day("2010-12-01", 20)
    shop.day("2010-12-02", 10)
    run(spark, shop.spec())
    return shop


def test_day_aggregates_read_no_data_column(loaded):
    for frame in (partition_counts(loaded.rows()), high_water_mark(loaded.rows())):
        assert "ReadSchema: struct<>" in physical(frame)


def test_day_filter_prunes_partitions(loaded):
    one = physical(loaded.rows().where("datestr = 20101202"))
    assert "PartitionFilters: [isnotnull(datestr" in one


def test_catalog_keys_scan_no_file(spark, loaded):
    assert "FileScan" not in physical(high_water_mark(partition_keys(spark, loaded.table)))


def test_report_scans_once_and_shuffles_rows_once(loaded):
    text = physical(post_load_report(loaded.rows()))
    assert text.count("FileScan") == 1
    wide = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert sum("InvoiceNo" in keys for keys in wide) == 1
    assert "partial_count" in text


def test_nothing_is_crossed_or_collected_to_one_task(loaded):
    frames = [
        post_load_report(loaded.rows()),
        load_profile(loaded.rows()),
        already_processed(
            list_files(loaded.spark, loaded.spec().inbound), high_water_mark(loaded.rows())
        ),
    ]
    for frame in frames:
        text = plan(frame)
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
        assert "collect_list" not in text


def big_day(shop, rows):
    pad = "x" * 100
    shop.file(
        "2010-12-01.csv", [invoice(i, "2010-12-01 08:00:00", pad) for i in range(rows)]
    )


def test_a_large_file_is_written_by_many_tasks(spark, shop):
    big_day(shop, 20_000)
    shop.day("2010-12-02", 10)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        run(spark, shop.spec())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list((shop.root / "table" / "datestr=20101201").glob("*.parquet"))) > 4
    assert shop.counts() == {20101201: 20_000, 20101202: 10}


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_rebalance_splits_a_hot_day_and_joins_small_parts(spark, shop, mode):
    big_day(shop, 40_000)
    for part in range(20):
        shop.day("2010-12-02", 5, first=100 * part, suffix=f".{part}.csv")
    spec = shop.spec(mode=mode, rebalance=True)
    small = {
        "spark.sql.files.maxPartitionBytes": "512k",
        "spark.sql.files.openCostInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        done = run(spark, spec)
        assert done.rows == 40_100
        again = load_files(spark, spec, list_files(spark, spec.inbound))
        assert again.rows == 40_100
    finally:
        for key in small:
            spark.conf.unset(key)
    times = 2 if mode == "append" else 1
    assert shop.counts() == {20101201: 40_000 * times, 20101202: 100 * times}
    hot = len(list((shop.root / "table" / "datestr=20101201").glob("*.parquet")))
    cold = len(list((shop.root / "table" / "datestr=20101202").glob("*.parquet")))
    assert hot > 2 * times
    assert cold == times


def test_a_repeated_row_is_counted_before_the_shuffle(spark):
    """A third of all rows are one row; map-side counting sends one line per task."""
    rows = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.lit(20240101).alias("datestr"),
    )
    profile = load_profile(rows)
    below_the_shuffle = physical(profile).rsplit("Exchange hashpartitioning", 1)[1]
    assert "partial_count(1)" in below_the_shuffle
    assert tuple(profile.first()) == (300_000, 200_001)

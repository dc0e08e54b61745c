import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions import day_key, file_key


@pytest.mark.parametrize(
    "text, key",
    [
        ("2010-12-02 07:48:00", 20101202),
        ("2010-12-02T07:48:00", 20101202),
        ("2010-12-02", 20101202),
        ("2010-1-2", 20100102),
        ("0001-01-01", 10101),
        ("-0001-02-03", 10203),
        ("300000-01-01", None),
        ("bad", None),
        ("2010-13-01", None),
        ("", None),
        (None, None),
    ],
)
def test_day_key_of_text(spark, text, key):
    assert spark.createDataFrame([(text,)], "d string").select(day_key("d")).first()[0] == key


def test_day_key_does_not_depend_on_the_zone(spark):
    late = dt.datetime(2024, 1, 1, 23, 59, 59)
    frame = spark.createDataFrame([(late,)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert frame.select(day_key("t")).first()[0] == 20240101
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(), min_size=1, max_size=200))
def test_day_key_is_the_date_without_dashes(spark, days):
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    spelled = F.regexp_replace(F.col("d").cast("string"), "-", "").cast("int")
    assert frame.where(~day_key("d").eqNullSafe(spelled)).count() == 0


@pytest.mark.parametrize(
    "name, key",
    [
        ("2010-12-02.csv", 20101202),
        ("2010-12-02.1.csv", 20101202),
        ("20101202", 20101202),
        ("junk.csv", None),
        (".csv", None),
        ("2010-12-02-extra99.csv", None),
        ("99999999999.csv", None),
    ],
)
def test_file_key(spark, name, key):
    assert spark.createDataFrame([(name,)], "n string").select(file_key("n")).first()[0] == key


def test_keys_hold_with_ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        frame = spark.createDataFrame([("bad", "junk.csv")], "d string, n string")
        assert tuple(frame.select(day_key("d"), file_key("n")).first()) == (None, None)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")

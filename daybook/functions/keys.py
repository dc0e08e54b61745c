"""Integer day keys.

A row's key comes from its own date or timestamp (``2010-12-02 07:48:00`` ->
``20101202``); a file's key comes from its name (``2010-12-02.csv`` ->
``20101202``). Both are built-in expressions, so they stay inside whole-stage
codegen, and neither fails on bad input: what cannot be read becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day_key(value: Column | str) -> Column:
    """``yyyyMMdd`` as int of a date, timestamp or ISO-like string; else NULL.

    Same values as rendering the date as text, dropping the dashes and casting
    to int, but in integer arithmetic: no string is built and no regular
    expression runs per row. A year too large for an int gives NULL.
    """
    day = _column(value).try_cast("date")
    years = F.try_multiply(F.abs(F.year(day)), F.lit(10000))
    return F.try_add(years, F.month(day) * 100 + F.dayofmonth(day))


def file_key(name: Column | str) -> Column:
    """Key of a file name: its text before the first dot, without dashes, as int.

    ``2010-12-02.csv`` and ``2010-12-02.1.csv`` give 20101202; a name that is no
    number, such as ``junk.csv``, gives NULL.
    """
    stem = F.substring_index(_column(name), ".", 1)
    return F.replace(stem, F.lit("-"), F.lit("")).try_cast("int")

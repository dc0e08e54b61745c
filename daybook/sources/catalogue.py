"""What pending files are, before any of them is loaded: header and content.

One job scans the lines of all files, however many, and gives a row per file: its first line
and a digest of its content. Lines are added up map-side, so a file that is split into many
tasks sends a row for each.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.landing import header_of, literal

#: Options of the CSV reader that decide where lines are and how they are spelled.
_LINE_OPTIONS = {"encoding", "charset", "comment", "linesep"}
#: A character no text has: lines are not split into fields.
_NO_SEPARATOR = "\ufdd0"


def _lines(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> DataFrame:
    kept = {k: v for k, v in options.items() if k.lower() in _LINE_OPTIONS}
    whole = {"sep": _NO_SEPARATOR, "quote": "", "escape": "", "header": "false"}
    reader = spark.read.options(**kept).options(**whole)
    return reader.csv([literal(p) for p in paths], schema="line string").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "line"
    )


def same_spelling(path: str) -> str:
    """A path as a listing writes it: the scan's file column is a URI."""
    return re.sub(r"\Afile:/+", "file:/", path)


def content_digests(
    spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None
) -> dict[str, tuple[str | None, str]]:
    """For each file its first line and a digest of all its lines in any order.

    Empty lines and those that the ``comment`` option hides do not count; a file without
    others has no first line and the digest of none. The digest is the number of lines and
    the sums of both halves of a 64-bit hash of each, so equal lines count as often as they
    stand there.
    """
    found = {same_spelling(p): (None, "0-0-0") for p in paths}
    if not paths:
        return {}
    number, hashed = F.monotonically_increasing_id(), F.xxhash64("line")
    lines = _lines(spark, paths, options or {}).withColumn("number", number).withColumn("hash", hashed)
    files = lines.groupBy("file").agg(
        F.min(F.when(F.col("block") == 0, F.struct("number", "line"))).alias("first"),
        F.count("*").alias("lines"),
        F.sum(F.col("hash").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(F.shiftrightunsigned("hash", 32)).alias("high"),
    )
    digest = F.concat_ws("-", "lines", "low", "high")
    for file, line, text in files.select("file", "first.line", digest).collect():
        found[same_spelling(unquote(file))] = (line, text)
    return {p: found[same_spelling(p)] for p in paths}


def with_headers(
    spark: SparkSession, files: pa.Table, options: Mapping[str, str] | None = None
) -> tuple[pa.Table, dict[str | None, list[str]]]:
    """``files`` with ``header``, their first lines, and ``digest``; and the column names of
    each different header, which one file of each is asked for."""
    paths = files["path"].to_pylist()
    found = content_digests(spark, paths, options)
    lines = [found[p][0] for p in paths]
    names: dict[str | None, list[str]] = {}
    for path, line in sorted(zip(paths, lines, strict=True)):
        if line not in names:
            names[line] = [] if line is None else header_of(spark, literal(path), options)
    files = files.append_column("header", pa.array(lines, pa.string()))
    return files.append_column("digest", pa.array([found[p][1] for p in paths], pa.string())), names

"""Landing folders: which files are there, and what is in them."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import day_key, file_key
from daybook.workspace import path_exists

DAY = "datestr"

# The fixed schema of Spark's binaryFile source; a stream has to name it.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


class MissingFolderError(FileNotFoundError):
    """A landing or staging folder does not exist."""


def read_if_there(reader: DataFrameReader, path: str | Sequence[str]) -> DataFrame | None:
    """``reader.load(path)``, or None if the path does not exist."""
    paths = [path] if isinstance(path, str) else path
    if not any(path_exists(reader._spark, p) for p in paths):
        return None
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def describe_files(raw: DataFrame) -> DataFrame:
    """(path, file_name, file_value, length) of a ``binaryFile`` frame, batch or stream.

    ``content`` is not selected, so it is pruned from the scan: no file is read.
    """
    name = F.substring_index("path", "/", -1)
    return raw.select(
        "path",
        name.alias("file_name"),
        file_key(name).alias("file_value"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


#: Without it the file source takes ``key=value`` sub-folders for partitions and, if there
#: is one, leaves out the files beside it.
ALL_BELOW = {"recursiveFileLookup": "true"}


def directly_in(folders: str | Sequence[str]) -> Column:
    """That ``path`` lies in one of the folders, which may be globs, and not below."""
    paths = [folders] if isinstance(folders, str) else list(folders)
    return F.col("path").rlike("|".join(f"(?:{_in_folder(p)})" for p in paths))


def _in_folder(folder: str) -> str:
    """The pattern of the paths of files directly in a folder or glob of folders."""
    plain = re.sub(r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", folder)
    plain = posixpath.normpath(plain)
    parts, depth, at = [], 0, 0
    while at < len(plain):
        char = plain[at]
        if char == "\\" and at + 1 < len(plain):
            at += 1
            parts.append(re.escape(plain[at]))
        elif char == "[" and "]" in plain[at:]:
            end = plain.index("]", at)
            parts.append("[" + plain[at + 1 : end].replace("!", "^", 1) + "]")
            at = end
        elif char == "{":
            depth += 1
            parts.append("(?:")
        elif char == "}" and depth:
            depth -= 1
            parts.append(")")
        elif char == "," and depth:
            parts.append("|")
        else:
            parts.append({"*": "[^/]*", "?": "[^/]"}.get(char) or re.escape(char))
        at += 1
    start = r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?" if plain.startswith("/") else "(?:\\A|/)"
    return f"{start}{''.join(parts).rstrip('/')}/[^/]+\\z"


def list_files(
    spark: SparkSession, folders: str | Sequence[str], below: bool = False
) -> DataFrame:
    """One row per plain file directly in ``folders``, or also ``below`` them.

    Left out are zero-byte files and names starting with ``_`` or ``.``; a file with
    only a header is listed.
    """
    paths = [folders] if isinstance(folders, str) else list(dict.fromkeys(folders))
    raw = read_if_there(spark.read.format("binaryFile").options(**ALL_BELOW), paths)
    if raw is None:
        raise MissingFolderError(f"no such folder among {paths}")
    return describe_files(raw if below else raw.where(directly_in(paths)))


def literal(path: str) -> str:
    """A listed path as the reader takes it: not as a glob."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_frame(spark: SparkSession, files: pa.Table) -> DataFrame:
    """A file list from the driver as a DataFrame.

    Chunks are joined first: of a table with an empty chunk, ``createDataFrame``
    takes only the rows ahead of it.
    """
    return spark.createDataFrame(files.combine_chunks())


def header_of(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> list[str]:
    """Column names in the first line of one CSV file."""
    return spark.read.options(**(options or {})).csv(path, header=True).columns


def read_days(
    spark: SparkSession,
    paths: str | Sequence[str],
    day_column: str,
    columns: Sequence[str] | None = None,
    source_column: str | None = None,
    malformed_column: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Landing CSVs: every column a string, plus ``datestr`` as the last column.

    ``source_column`` names a column that is to hold each row's file name,
    ``malformed_column`` one for the text of rows with too few or too many fields, which
    is NULL for all others; ``options`` are those of the CSV reader.
    ``columns`` defaults to the header of the first path. One schema serves the
    whole scan, and each file's header is checked against it: a file with other
    names or another order fails the read instead of loading by position.
    Files stay splittable, so one large file is read by many tasks.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    columns = list(columns) if columns is not None else header_of(spark, paths[0], options)
    reader = spark.read.options(**(options or {}))
    if malformed_column:
        columns = [*columns, malformed_column]
        reader = reader.option("columnNameOfCorruptRecord", malformed_column)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    rows = reader.csv(paths, schema=schema, header=True, enforceSchema=False)
    if source_column:
        rows = rows.select("*", F.col("_metadata.file_name").alias(source_column))
    return with_datestr(rows, day_column)


def with_datestr(df: DataFrame, day_column: str) -> DataFrame:
    """Append the day key of ``day_column`` as the last column, ``datestr``."""
    return df.drop(DAY).withColumn(DAY, day_key(day_column))

"""Where scratch tables go: the shared folder the cluster names."""

from __future__ import annotations

import shutil
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"

_own_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder, the same one
    for as long as the application runs; a cluster without it is an error,
    because a machine-local folder is not visible to the other machines.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="daybook-")
    return _own_roots[application]


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the scratch root."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, which may be a glob. A read that fails
    tells as well, but fills the log with its stack trace."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def complete_folders(spark: SparkSession, root: str) -> list[str]:
    """The folders in ``root`` whose write has ended, by name."""
    context = spark.sparkContext
    ended = context._jvm.org.apache.hadoop.fs.Path(f"{root}/*/_SUCCESS")
    found = ended.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(ended)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def delete_paths(spark: SparkSession, paths: list[str], within: str | None = None) -> None:
    """Delete files or folders that are there, if the folder ``within`` is."""
    if within is not None and not path_exists(spark, within):
        return
    context = spark.sparkContext
    for path in paths:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def _located(spark: SparkSession, path: str) -> tuple:
    """A path's file system, and the path as that takes it."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file; False if there is one."""
    files, where = _located(spark, path)
    try:
        out = files.create(where, False)
    except Py4JJavaError:
        if files.exists(where):
            return False
        raise
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str | None:
    """What a small file holds, or None if it is not there."""
    files, where = _located(spark, path)
    try:
        stream = files.open(where)
    except Py4JJavaError:
        if files.exists(where):
            raise
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def file_age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file's time, or None if it is not there."""
    files, where = _located(spark, path)
    found = files.globStatus(where)
    return time.time() - found[0].getModificationTime() / 1000 if found else None


def touch_file(spark: SparkSession, path: str) -> None:
    """Set a file's time to now."""
    files, where = _located(spark, path)
    files.setTimes(where, int(time.time() * 1000), -1)


def move_file(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a file; False if it is not there (any more)."""
    files, where = _located(spark, path)
    try:
        return files.rename(where, _located(spark, to)[1])
    except Py4JJavaError:
        if files.exists(where):
            raise
        return False


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this application, and what lies beside them.

    To be called when no DataFrame that reads them is needed any more, at the latest
    before the session ends.
    """
    application = spark.sparkContext.applicationId
    for path in _made.pop(application, []):
        delete_paths(spark, [path, f"{path}_ledger", f"{path}_quarantine", f"{path}_profile"])
    root = _own_roots.pop(application, None)
    if root:
        shutil.rmtree(root, ignore_errors=True)

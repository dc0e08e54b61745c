"""One writer at a time: a load holds a claim, a file next to its table.

The file is made only if there is none, which is exclusive where the file system's own
creation is, as HDFS's. While the load runs, a thread sets the file's time; a claim whose
time is older than ``LoadSpec.claim_minutes`` belongs to a load that died, and the next load
takes its place. Machines' clocks are taken to agree within that time.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from daybook.plans.spec import LoadSpec
from daybook.workspace import create_file, delete_paths, file_age, move_file, read_file, touch_file

#: Claims that the running call holds; another thread of the same driver holds none of them.
_held: ContextVar[frozenset[str]] = ContextVar("held", default=frozenset())


class ConcurrentLoadError(RuntimeError):
    """Another load of the table is running."""


@contextmanager
def claimed(spark: SparkSession, spec: LoadSpec) -> Iterator[None]:
    """Hold the claim on the table; an error if another load does. A load within a load of the
    same call needs no claim of its own."""
    path = spec.claim_path
    if path in _held.get():
        yield
        return
    own = f"{spark.sparkContext.applicationId} {uuid.uuid4().hex}"
    _take(spark, spec, own)
    done = threading.Event()
    alive = threading.Thread(target=_keep, args=(spark, path, spec.claim_minutes * 15, done), daemon=True)
    alive.start()
    mark = _held.set(_held.get() | {path})
    try:
        yield
    finally:
        _held.reset(mark)
        done.set()
        alive.join()
        if read_file(spark, path) == own:
            delete_paths(spark, [path])


def _take(spark: SparkSession, spec: LoadSpec, own: str) -> None:
    path = spec.claim_path
    if create_file(spark, path, own):
        return
    holder, age = read_file(spark, path), file_age(spark, path)
    if holder is not None and age is not None and age > spec.claim_minutes * 60:
        # of several that find it dead, one moves it; what it moved must be what it found
        aside = f"{path}.{uuid.uuid4().hex}"
        if move_file(spark, path, aside):
            if read_file(spark, aside) != holder:
                move_file(spark, aside, path)
            else:
                delete_paths(spark, [aside])
                if create_file(spark, path, own):
                    return
    elif holder is None and create_file(spark, path, own):  # it has just ended
        return
    raise ConcurrentLoadError(
        f"{spec.table} is being loaded by {holder}; its claim {path} ends with that load, or counts "
        f"for nothing once it has been left alone for {spec.claim_minutes:g} minutes"
    )


def _keep(spark: SparkSession, path: str, seconds: float, done: threading.Event) -> None:
    while not done.wait(seconds):
        touch_file(spark, path)

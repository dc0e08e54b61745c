"""Session settings that hold for one action."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession


#: Executors of a session that allocates them on demand may not be up yet.
LEAST_TASKS = 64


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set ``name`` inside the block and put it back as it was afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def listing_in_few_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """List folders in about one task per core, not in one task per folder.

    A table of thousands of days is listed several times as fast.
    """
    tasks = max(spark.sparkContext.defaultParallelism, LEAST_TASKS)
    return setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))


def files_in_few_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Scan files in one task per core. For scans that open no file, however large
    the files are; not for reading them."""
    return setting(
        spark, "spark.sql.files.maxPartitionNum", str(spark.sparkContext.defaultParallelism)
    )

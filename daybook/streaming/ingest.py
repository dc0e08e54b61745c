"""Ingestion as a stream of new files.

The stream carries the file list, not the rows: the file source remembers which
files it has handed out, and each micro-batch of names goes through the batch
loader. So a micro-batch that holds only part of a day, or a replay under a new
checkpoint, ends in the same table as a batch run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from daybook.plans import LoadResult, LoadSpec, ledger, load_files
from daybook.sources import table_exists
from daybook.sources.landing import ALL_BELOW, FILE_SCHEMA, describe_files, directly_in


def ingest_new(
    spark: SparkSession, spec: LoadSpec, checkpoint: str, max_files: int | None = None
) -> list[LoadResult]:
    """Load all inbound files that have landed since the last run, then stop.

    ``max_files`` bounds the files per micro-batch.
    """
    return _load_stream(spark, spec, spec.inbound, ledger.INBOUND, checkpoint, max_files, {})


def drain_staged(
    spark: SparkSession,
    spec: LoadSpec,
    checkpoint: str,
    archive: str,
    max_files: int | None = None,
) -> list[LoadResult]:
    """Load all staged files and move them to ``archive``.

    Files of sub-folders are moved as well, but not loaded.
    The source moves a file while a later batch runs, so the last files stay
    behind; the ledger, not the folder, says what is loaded.
    """
    move = {"cleanSource": "archive", "sourceArchiveDir": archive}
    spec = replace(spec, archive=archive)
    return _load_stream(spark, spec, spec.staging, ledger.STAGING, checkpoint, max_files, move)


def _load_stream(
    spark: SparkSession,
    spec: LoadSpec,
    folder: object,
    origin: str,
    checkpoint: str,
    max_files: int | None,
    options: dict[str, str],
) -> list[LoadResult]:
    if not isinstance(folder, str):
        raise ValueError("a stream reads one folder; name it by one path or glob")
    if max_files is not None:
        options = {**options, "maxFilesPerTrigger": str(max_files)}
    results: list[LoadResult] = []

    def load(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        if table_exists(session, spec.table):
            loaded = ledger.loaded_files(session, spec)
            ledger.refuse_changed(session, spec, files, loaded)
            files = ledger.without_loaded(files, loaded)
        results.append(load_files(session, spec, files, origin))

    options = {**options, **ALL_BELOW}
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**options)
    query = (
        describe_files(reader.load(folder).where(directly_in(folder)))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results

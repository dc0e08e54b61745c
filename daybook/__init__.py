"""Incremental, file-at-a-time ingestion into day-partitioned tables on Spark."""

from daybook.plans import LoadResult, LoadSpec, load_files, run

__all__ = ["LoadResult", "LoadSpec", "load_files", "run"]

"""Run-once streams that feed the same load job."""

from daybook.streaming.ingest import drain_staged, ingest_new

__all__ = ["drain_staged", "ingest_new"]

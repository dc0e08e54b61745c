"""Landing folders and catalogued tables as DataFrames."""

from daybook.sources.catalogue import content_digests
from daybook.sources.export import export_days
from daybook.sources.landing import MissingFolderError, list_files, read_days
from daybook.sources.tables import partition_keys, table_exists

__all__ = [
    "MissingFolderError",
    "content_digests",
    "export_days",
    "list_files",
    "partition_keys",
    "read_days",
    "table_exists",
]

"""Aggregates and checks over rows and over file lists."""

from daybook.operators.days import (
    batch_date_range,
    high_water_mark,
    loaded_partitions,
    partition_counts,
    preview,
)
from daybook.operators.files import (
    already_processed,
    earliest_file,
    latest_file,
    pending_files,
)
from daybook.operators.profile import (
    day_profile,
    duplicate_profile,
    load_profile,
    post_load_report,
)

__all__ = [
    "already_processed",
    "batch_date_range",
    "day_profile",
    "duplicate_profile",
    "earliest_file",
    "high_water_mark",
    "latest_file",
    "load_profile",
    "loaded_partitions",
    "partition_counts",
    "pending_files",
    "post_load_report",
    "preview",
]

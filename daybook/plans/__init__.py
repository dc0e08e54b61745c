"""What to load, where to, and the load itself."""

from daybook.plans.claim import ConcurrentLoadError
from daybook.plans.ledger import ChangedFileError, InterruptedLoadError, settle
from daybook.plans.loads import IncompleteDayError, LoadResult, load_files, run
from daybook.plans.report import incremental_report
from daybook.plans.spec import LoadSpec
from daybook.plans.writes import SchemaMismatchError

__all__ = [
    "ChangedFileError",
    "ConcurrentLoadError",
    "IncompleteDayError",
    "InterruptedLoadError",
    "LoadResult",
    "LoadSpec",
    "SchemaMismatchError",
    "incremental_report",
    "load_files",
    "run",
    "settle",
]

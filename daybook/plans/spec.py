"""Settings of a load job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class LoadSpec:
    """One target table and the folders it is fed from.

    table       qualified name, ``db.table``
    location    folder of the external table; the ledger and the quarantine lie
                next to it
    inbound     folder(s) of landing files
    staging     folder(s) a requested load takes its next file from
    day_column  column the ``datestr`` partition key is derived from
    mode        ``replace``: the loaded days are replaced, so a load can be
                repeated; a row belongs in the file of its own day and is
                quarantined otherwise. ``append``: rows are added whatever day
                they have, and a repeated load adds them again
    check       ``ledger``: a file is pending until it has been loaded.
                ``high_water``: a file is pending if its key is not the table's
                latest day (with ``latest_only``) or lies after it (without)
    latest_only consider only the latest landing file, not all of them
    fmt         table format
    rebalance   shuffle rows by day before the write. Needed only if files mix
                many days; files of one day each are written without a shuffle
    options     options of the CSV reader, such as ``{"sep": ";"}`` or
                ``{"multiLine": "true"}`` for line breaks in quoted fields
    archive     folder a stream moves staged files to; searched, with all that is
                below it, when a day has to be loaded anew
    columns     names of the data columns, in the table's order, for a first load. If None,
                those that most of its files have, in the order of the earliest such file
    days_per_load  load this many days at a time, each with its own lines in the
                ledger, so that a failure costs one group; all at once if None. Groups
                go by day, so with 1 days are loaded in the order of their files' names
    claim_minutes  after how long the claim of a load that died counts for nothing
    """

    table: str
    location: str
    inbound: str | Sequence[str]
    staging: str | Sequence[str] | None = None
    day_column: str = "InvoiceDate"
    mode: str = "replace"
    check: str = "ledger"
    latest_only: bool = False
    fmt: str = "parquet"
    rebalance: bool = False
    options: Mapping[str, str] = field(default_factory=dict)
    archive: str | None = None
    columns: Sequence[str] | None = None
    days_per_load: int | None = None
    claim_minutes: float = 10

    def __post_init__(self) -> None:
        if not self.table or not self.location:
            raise ValueError("table and location must not be empty")
        if self.mode not in ("replace", "append"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.check not in ("ledger", "high_water"):
            raise ValueError(f"unknown check {self.check!r}")
        if self.days_per_load is not None and self.days_per_load < 1:
            raise ValueError("days_per_load must be at least 1")
        if self.claim_minutes <= 0:
            raise ValueError("claim_minutes must be more than 0")

    @classmethod
    def classic(cls, **settings) -> LoadSpec:
        """Latest file only, compared with the latest day, appended."""
        return cls(mode="append", check="high_water", latest_only=True, **settings)

    @property
    def ledger_path(self) -> str:
        return f"{self.location.rstrip('/')}_ledger"

    @property
    def claim_path(self) -> str:
        return f"{self.location.rstrip('/')}_claim"

    @property
    def profile_path(self) -> str:
        return f"{self.location.rstrip('/')}_profile"

    @property
    def quarantine_path(self) -> str:
        return f"{self.location.rstrip('/')}_quarantine"

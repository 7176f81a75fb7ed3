"""Where each dataset of the lake lives, and the identity of one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lifecycle zones, from arrival to serving.
ZONES = (
    "raw",
    "validated",
    "processed",
    "master",
    "scd2",
    "curated",
    "export",
    "audit",
    "quarantine",
    "backup",
)


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, zone: str, dataset: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}; zones are {', '.join(ZONES)}")
        return f"{self.root.rstrip('/')}/{zone}/{dataset.strip('/')}"


@dataclass(frozen=True)
class Run:
    """``run_ts`` is the one clock of a run: keys, validity dates and audits all take it from here."""

    run_id: str
    run_ts: str

    @property
    def clock(self) -> datetime:
        return datetime.fromisoformat(self.run_ts)

    @property
    def at(self) -> Column:
        return timestamp_literal(self.run_ts)


def timestamp_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")

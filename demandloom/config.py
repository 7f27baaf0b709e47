"""Settings shared by the batch runs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# The first day of the retail data, the trailing window length and the split shares.
BASE_DATE = dt.date(2011, 1, 29)
TRAILING_DAYS = 365
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.85


@dataclass(frozen=True)
class PipelineConfig:
    """Where the tables live and how a run is stamped.

    ``clock`` is the processing time written into the tables; leave it unset to use the time of the run.
    """

    root: str
    base_date: dt.date = BASE_DATE
    version: str = "v1"
    feature_version: str = "v1"
    pipeline_name: str = "demand_features"
    etl_job: str = "demand_etl"
    ml_job: str = "demand_models"
    triggered_by: str = "scheduler"
    clock: dt.datetime | None = None
    states: tuple[str, ...] = ("CA", "TX", "WI")
    event_types: tuple[str, ...] = ("Sporting", "Cultural", "National", "Religious")
    model_rounds: int = 1000
    tails_kept: int = 2  # newest series tails; an older rerun reads the whole history
    snapshots_kept: int = 200  # published states that readers may still be on

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def now(self) -> dt.datetime:
        if self.clock is not None:
            return self.clock
        return dt.datetime.now(dt.timezone.utc)

"""Run parameters shared by every model (cutoff, lookbacks, refresh mode)."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    """Parameters of one refresh.

    execution_date: inclusive cutoff. Events with time <= this instant are
        processed; a date-only value means midnight (that day's later events
        are excluded). Periods whose start date is <= its date are emitted.
        ``None`` or blank disables the cutoff.
    late_arrival_lookback_days: event models reprocess events newer than
        ``max(target time) - lookback`` (strictly newer).
    period_lookback_days: period models rewrite periods newer than
        ``max(target period) - lookback`` (strictly newer).
    full_refresh: ignore existing targets and rebuild from the source.
    power_user_min_events: events in one period/segment that make a user a
        "power user".
    dim_buckets: buckets of the stored user dimension, taken at a full build
        (about one for each 100 MB of its rows).
    """

    execution_date: str | None = None
    late_arrival_lookback_days: int = 1
    period_lookback_days: int = 62
    full_refresh: bool = False
    power_user_min_events: int = 3
    dim_buckets: int = 64

    def cutoff_ts(self) -> dt.datetime | None:
        """Cutoff as a naive UTC datetime (offsets are converted to UTC)."""
        if self.execution_date is None or not str(self.execution_date).strip():
            return None
        ts = dt.datetime.fromisoformat(str(self.execution_date).strip())
        if ts.tzinfo is not None:
            ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return ts

    def cutoff_date(self) -> dt.date | None:
        ts = self.cutoff_ts()
        return None if ts is None else ts.date()

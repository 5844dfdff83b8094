"""Typed literals."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from .sqlexpr import ntz_literal


def ts_ntz(ts: dt.datetime) -> Column:
    """Literal of a naive (UTC) datetime as TIMESTAMP_NTZ: comparisons with the
    engine's zone-less timestamps never depend on the session time zone."""
    return F.expr(ntz_literal(ts))

"""Staging: typed, cleaned, keyed events (one row per event_id)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import sqlexpr as sx, ts_ntz
from ..params import RunParams

STG_COLUMNS = ["event_id", "event_time_utc", "user_id", "gender", "event_type",
               "transaction_category", "miles_amount", "platform", "utm_source", "country",
               "event_date_utc", "event_week_utc", "event_month_utc", "loaded_at"]


def time_window(df: DataFrame, col: str, after: dt.datetime | None,
                upto: dt.datetime | None, date_col: str | None = None) -> DataFrame:
    """Keep rows with ``after < col <= upto`` (either bound optional).

    Bounds are literals, so they reach the Parquet scan as pushed filters.
    When the frame also carries the day of ``col`` (``date_col``, the
    partition column of stored event tables) the implied day bounds are
    added, which prunes whole date partitions before any file is opened.
    """
    c = F.col(col).cast("timestamp_ntz")
    if after is not None:
        df = df.filter(c > ts_ntz(after))
        if date_col:
            df = df.filter(F.col(date_col) >= F.lit(after.date()))
    if upto is not None:
        df = df.filter(c <= ts_ntz(upto))
        if date_col:
            df = df.filter(F.col(date_col) <= F.lit(upto.date()))
    return df


def stg_events(raw: DataFrame, params: RunParams = RunParams(),
               after: dt.datetime | None = None) -> DataFrame:
    """raw events -> staging rows.

    ``after`` is the incremental lower bound (target watermark minus the
    late-arrival lookback, exclusive); the cutoff comes from ``params``.
    Rows without a user or a time are dropped; rows with a null event type
    are kept.
    """
    # a stored raw table partitioned by event day lets the bounds prune days
    day_col = "event_date" if "event_date" in raw.columns else None
    src = time_window(raw, "event_time", after, params.cutoff_ts(), date_col=day_col)
    typed = src.selectExpr(
        "CAST(event_time AS TIMESTAMP_NTZ) AS event_time_utc",
        "CAST(user_id AS STRING) AS user_id",
        f"{sx.clean_text('gender')} AS gender",
        f"{sx.clean_text('event_type', 'lower')} AS event_type",
        f"{sx.clean_text('transaction_category', 'lower')} AS transaction_category",
        "CAST(miles_amount AS DECIMAL(38,9)) AS miles_amount",
        f"{sx.clean_text('platform', 'lower')} AS platform",
        f"{sx.clean_text('utm_source', 'lower')} AS utm_source",
        f"{sx.clean_text('country', 'upper')} AS country",
        "CAST(loaded_at AS TIMESTAMP_NTZ) AS loaded_at",
    ).filter("user_id IS NOT NULL AND event_time_utc IS NOT NULL")
    return typed.selectExpr(
        f"{sx.event_key('event_time_utc', 'user_id', 'event_type', 'miles_amount', 'platform')} AS event_id",
        "event_time_utc", "user_id", "gender", "event_type", "transaction_category",
        "miles_amount", "platform", "utm_source", "country",
        "to_date(event_time_utc) AS event_date_utc",
        "CAST(trunc(to_date(event_time_utc), 'week') AS TIMESTAMP_NTZ) AS event_week_utc",
        "CAST(trunc(to_date(event_time_utc), 'month') AS TIMESTAMP_NTZ) AS event_month_utc",
        "loaded_at",
    )

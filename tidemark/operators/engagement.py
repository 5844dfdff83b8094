"""Engagement depth per (grain, period, segment)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import GRAINS
from ..functions import sqlexpr as sx
from .activity import SEGMENTS, period_window

ENGAGEMENT_COLUMNS = ["period_grain", "period_start", *SEGMENTS, "total_events", "active_users",
                      "events_per_active_user", "avg_miles_per_active_user", "power_users",
                      "power_user_share"]


def engagement_depth(periods: DataFrame, power_user_min_events: int = 3,
                     after: dt.date | None = None, upto: dt.date | None = None) -> DataFrame:
    """Aggregate user-period-segment rows (see ``user_period_segments``).

    Rows are unique per user, so active users is a count and power users a
    conditional count; all four aggregates combine map-side, which keeps the
    huge ``all`` groups cheap. Ratios are null when the divisor is zero.
    """
    p = period_window(periods, "period_start", after, upto)
    agg = (p.groupBy("period_grain", "period_start", *SEGMENTS)
           .agg(F.expr("CAST(sum(event_count) AS BIGINT) AS total_events"),
                F.expr("count(1) AS active_users"),
                F.expr("sum(miles_sum) AS total_miles"),
                F.expr(f"count_if(event_count >= {int(power_user_min_events)}) AS power_users")))
    return agg.selectExpr(
        "period_grain", "period_start", *SEGMENTS, "total_events", "active_users",
        "try_divide(CAST(total_events AS DOUBLE), active_users) AS events_per_active_user",
        "try_divide(CAST(total_miles AS DOUBLE), active_users) AS avg_miles_per_active_user",
        "power_users",
        "try_divide(CAST(power_users AS DOUBLE), active_users) AS power_user_share",
    )


def power_users(periods: DataFrame, power_user_min_events: int = 3) -> DataFrame:
    """The power users themselves: user-period-segment rows at or above the threshold."""
    return (periods.filter(F.col("event_count") >= power_user_min_events)
            .selectExpr("period_grain", "period_start", *SEGMENTS, "user_id",
                        "CAST(event_count AS BIGINT) AS event_count"))


def event_mix(fct: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """(period_grain, period_start, event_type, events, share): how a period's
    events divide into types (a missing type is one of its own). Events are
    counted by day and type once; periods and shares are made from these counts."""
    daily = fct.groupBy("event_date_utc", "event_type").agg(F.count(F.lit(1)).alias("n"))
    periods = ", ".join(f"named_struct('period_grain', '{g}', 'period_start', {sx.period_start_for(g, 'event_date_utc')})" for g in grains)
    counts = (daily.selectExpr("event_type", "n", f"inline(array({periods}))")
              .groupBy("period_grain", "period_start", "event_type").agg(F.sum("n").cast("long").alias("events")))
    return counts.selectExpr("*", "events / CAST(sum(events) OVER (PARTITION BY period_grain, period_start) AS DOUBLE) AS share")

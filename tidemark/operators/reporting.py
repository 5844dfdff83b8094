"""BI-facing shapes of the growth mart (dashboard datasets).

All stay distributed DataFrames; nothing is pulled to the driver.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from .activity import ALL, SEGMENTS
from .growth import GROWTH_METRICS


def select_view(df: DataFrame, grain: str | None = None, start: dt.date | None = None,
                end: dt.date | None = None,
                segment: tuple[str, str, str] | None = (ALL, ALL, ALL),
                grain_col: str = "period_grain", period_col: str = "period_start") -> DataFrame:
    """Dashboard controls: grain dropdown, inclusive date range, segment."""
    if grain is not None:
        df = df.filter(F.col(grain_col) == grain)
    if start is not None:
        df = df.filter(F.col(period_col) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(period_col) <= F.lit(end))
    if segment is not None:
        for col, val in zip(SEGMENTS, segment):
            df = df.filter(F.col(col) == val)
    return df


def growth_long_form(growth: DataFrame, grain: str | None = None,
                     segment: tuple[str, str, str] | None = (ALL, ALL, ALL)) -> DataFrame:
    """Melt the five metrics: (period_grain, period_start, metric, value),
    ordered by grain then period for charting."""
    g = select_view(growth, grain, segment=segment)
    return (g.unpivot(["period_grain", "period_start"], GROWTH_METRICS, "metric", "value")
            .orderBy("period_grain", "period_start", "metric"))


def growth_scorecards(growth: DataFrame, grain: str | None = None, start: dt.date | None = None,
                      end: dt.date | None = None,
                      segment: tuple[str, str, str] | None = (ALL, ALL, ALL)) -> DataFrame:
    """Scorecards: each metric summed over the selected periods, per grain."""
    g = select_view(growth, grain, start, end, segment)
    return g.groupBy("period_grain").agg(
        F.count(F.lit(1)).alias("periods"),
        F.min("period_start").alias("first_period"),
        F.max("period_start").alias("last_period"),
        *[F.sum(m).cast("long").alias(m) for m in GROWTH_METRICS])


def growth_trend(growth: DataFrame, grain: str, start: dt.date | None = None,
                 end: dt.date | None = None,
                 segment: tuple[str, str, str] | None = (ALL, ALL, ALL)) -> DataFrame:
    """Trend chart dataset: one row per period, sorted ascending."""
    return (select_view(growth, grain, start, end, segment)
            .select("period_start", *GROWTH_METRICS).orderBy("period_start"))


def mart_for_bi(df: DataFrame, grain_col: str = "period_grain",
                period_col: str = "period_start") -> DataFrame:
    """Whole mart ordered by grain then period, as a dashboard reads it
    (a distributed range-partitioned sort; nothing is pulled to the driver)."""
    return df.orderBy(grain_col, period_col)

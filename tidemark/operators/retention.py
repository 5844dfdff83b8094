"""Cohort retention triangle (sparse long form) and its pivoted matrix."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import sqlexpr as sx
from .activity import SEGMENTS, period_window

COHORT_KEYS = ["cohort_grain", "cohort_start", *SEGMENTS]
TRIANGLE_COLUMNS = ["cohort_grain", "cohort_start", "activity_period_start", "period_index",
                    *SEGMENTS, "cohort_users", "retained_users", "retention_rate"]


CELL_COLUMNS = ["cohort_grain", "cohort_start", "activity_period_start", *SEGMENTS, "retained_users"]


def cohort_cells(activity: DataFrame) -> DataFrame:
    """Retained users per (grain, cohort, activity period, segment). Activity
    rows are unique per user, so a count (combined map-side) is the distinct
    count."""
    return (activity.selectExpr("period_grain AS cohort_grain", "first_active_period AS cohort_start",
                                "period_start AS activity_period_start", *SEGMENTS)
            .groupBy("cohort_grain", "cohort_start", "activity_period_start", *SEGMENTS)
            .agg(F.expr("count(1) AS retained_users")))


def finish_triangle(cells: DataFrame) -> DataFrame:
    """Cells -> triangle rows. The cohort size is the period-0 cell of the
    same cohort, read with a window over the (small) aggregated cells
    instead of a second aggregate and a join."""
    cohort = ", ".join(COHORT_KEYS)
    out = cells.selectExpr(
        *CELL_COLUMNS,
        f"{sx.period_index('cohort_grain', 'cohort_start', 'activity_period_start')} AS period_index",
        "max(CASE WHEN activity_period_start = cohort_start THEN retained_users END) "
        f"OVER (PARTITION BY {cohort}) AS cohort_users")
    return (out.filter("period_index >= 0")
            .selectExpr(*[c for c in TRIANGLE_COLUMNS if c != "retention_rate"],
                        "try_divide(retained_users, cohort_users) AS retention_rate"))


def cohort_retention_triangle(activity: DataFrame, upto: dt.date | None = None) -> DataFrame:
    """One row per existing (grain, cohort, activity period, segment) cell.

    The cohort of a user is its first active period in that grain and
    segment, taken from the full-history activity frame.
    """
    return finish_triangle(cohort_cells(period_window(activity, "period_start", None, upto)))


def cohort_retention_triangle_since(activity: DataFrame, existing: DataFrame, after: dt.date,
                                    upto: dt.date | None = None) -> DataFrame:
    """Incremental triangle: cells whose activity period starts after
    ``after`` come from ``activity`` (which must hold every period after
    ``after``, with full-history first periods); the other cells of each
    touched cohort are kept from ``existing``. The result covers the touched
    ``cohort_start`` partitions whole."""
    new = cohort_cells(period_window(activity, "period_start", after, upto))
    touched = new.select("cohort_start").distinct()
    kept = (existing.join(touched, "cohort_start", "left_semi")
            .filter(F.col("activity_period_start") <= F.lit(after)).select(*CELL_COLUMNS))
    return finish_triangle(kept.unionByName(new))


def cohort_sizes(activity: DataFrame, upto: dt.date | None = None) -> DataFrame:
    """Users per cohort: new users of each (grain, period, segment)."""
    a = period_window(activity, "period_start", None, upto).filter("is_new")
    return (a.selectExpr("period_grain AS cohort_grain", "period_start AS cohort_start", *SEGMENTS)
            .groupBy(*COHORT_KEYS).agg(F.expr("count(1) AS cohort_users")))


def cohort_matrix(triangle: DataFrame, grain: str,
                  segment: tuple[str, str, str] | None = ("all", "all", "all")) -> DataFrame:
    """Heat-map matrix: one row per cohort, columns ``p0 .. pN`` holding
    retention rates, where N is the largest period index of the selection
    (one small aggregate finds it), so no cell is left out."""
    t = triangle.filter(F.col("cohort_grain") == grain)
    if segment is not None:
        for col, val in zip(SEGMENTS, segment):
            t = t.filter(F.col(col) == val)
    widest = t.agg(F.max("period_index")).first()[0]
    values = list(range((widest or 0) + 1))
    m = (t.groupBy("cohort_grain", "cohort_start", *SEGMENTS, "cohort_users")
         .pivot("period_index", values).agg(F.first("retention_rate")))
    return m.select("cohort_grain", "cohort_start", *SEGMENTS, "cohort_users",
                    *[F.col(str(i)).alias(f"p{i}") for i in values])

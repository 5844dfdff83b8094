"""Period arithmetic for the three reporting grains.

Weeks start on Monday; months on the 1st. Periods are DATE values. The
grain can be a Python string (static dispatch) or a column (CASE dispatch).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import sqlexpr as sx

GRAINS = ("daily", "weekly", "monthly")


def period_start_for(grain: str, d: Column) -> Column:
    """Start date of the period of ``grain`` that contains date ``d``."""
    if grain == "daily":
        return d
    if grain == "weekly":
        return F.trunc(d, "week")
    if grain == "monthly":
        return F.trunc(d, "month")
    raise ValueError(f"unknown grain {grain!r}")


def _names(*cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def _dispatch(grain: Column, daily: Column, weekly: Column, monthly: Column) -> Column:
    return (F.when(grain == "daily", daily)
            .when(grain == "weekly", weekly)
            .when(grain == "monthly", monthly))


def period_start(grain: Column | str, d: Column | str) -> Column:
    if _names(grain, d):
        return F.expr(sx.period_start(grain, d))
    return _dispatch(grain, d, F.trunc(d, "week"), F.trunc(d, "month"))


def prior_period_start(grain: Column | str, p: Column | str) -> Column:
    """Start of the immediately preceding period of the same grain."""
    if _names(grain, p):
        return F.expr(sx.prior_period_start(grain, p))
    return _dispatch(grain, F.date_sub(p, 1), F.date_sub(p, 7), F.add_months(p, -1))


def next_period_start(grain: Column | str, p: Column | str) -> Column:
    """Start of the immediately following period of the same grain."""
    if _names(grain, p):
        return F.expr(sx.next_period_start(grain, p))
    return _dispatch(grain, F.date_add(p, 1), F.date_add(p, 7), F.add_months(p, 1))


def period_index(grain: Column | str, cohort_start: Column | str, activity_start: Column | str) -> Column:
    """Whole periods between two period starts of the same grain (LONG)."""
    if _names(grain, cohort_start, activity_start):
        return F.expr(sx.period_index(grain, cohort_start, activity_start))
    days = F.datediff(activity_start, cohort_start)
    months = ((F.year(activity_start) - F.year(cohort_start)) * 12
              + (F.month(activity_start) - F.month(cohort_start)))
    return _dispatch(grain, days, F.floor(days / 7), months).cast("long")

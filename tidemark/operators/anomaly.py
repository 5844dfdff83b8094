"""Volume and metric anomalies.

Everything here works on daily or period aggregates, never on events. Windows
are ranges of calendar time: a missing day or period counts as zero, because the
series are filled up first. All decisions are made in whole numbers (medians
times two, sums of squares), so they don't depend on the order of additions.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import sqlexpr as sx
from .activity import ALL, SEGMENTS
from .growth import GROWTH_METRICS

LOW_PERCENT, HIGH_PERCENT = 40, 250
VOLUME_WINDOWS = (7, 14)
VOLUME_DIMENSIONS = ("platform", "country")

PERIODS = 14
MIN_PERIODS = 7
MIN_CHANGE = 5
Z_LIMIT = 3.0
MAD_LIMIT = 3.5
#: Fixed value: makes a median deviation comparable with a standard deviation.
MAD_SCALE = 0.6745


# --------------------------------------------------------------------------- volume
def daily_volume(day_base: DataFrame, dimensions: tuple[str, ...] = VOLUME_DIMENSIONS) -> DataFrame:
    """(dimension, value, activity_date, events): events by day over all, and by
    each value of the dimensions. The base is read once; a day's few segment
    totals are what is spread over the dimensions."""
    totals = (day_base.groupBy("activity_date", *dimensions).agg(F.sum("event_count").cast("long").alias("events")))
    rows = ", ".join([f"named_struct('dimension', '{ALL}', 'value', '{ALL}')"]
                     + [f"named_struct('dimension', '{d}', 'value', {d})" for d in dimensions])
    return (totals.selectExpr("activity_date", "events", f"inline(array({rows}))")
            .groupBy("dimension", "value", "activity_date").agg(F.sum("events").cast("long").alias("events")))


def fill_days(volume: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Every series with a row for each day from ``first`` to ``last`` (by default
    the first and last day of any series); days without events have zero."""
    bounds = [F.lit(first) if first is not None else volume.agg(F.min("activity_date")).scalar(),
              F.lit(last) if last is not None else volume.agg(F.max("activity_date")).scalar()]
    days = (volume.select("dimension", "value").distinct()
            .select("dimension", "value", F.explode(F.sequence(*bounds)).alias("activity_date")))
    return (days.join(volume, ["dimension", "value", "activity_date"], "left")
            .select("dimension", "value", "activity_date", F.coalesce("events", F.lit(0)).alias("events")))


def volume_baseline(filled: DataFrame, days: int) -> DataFrame:
    """``filled`` with the exact median of the ``days`` calendar days before each
    day; null until that many days have passed."""
    day = F.datediff("activity_date", F.lit(dt.date(1970, 1, 1)))
    before = Window.partitionBy("dimension", "value").orderBy(day).rangeBetween(-days, -1)
    return filled.select(
        "*", F.when(F.count(F.lit(1)).over(before) == days, F.expr("percentile(events, 0.5)").over(before)).alias("median_events"))


def volume_outliers(day_base: DataFrame, days: int = 7, low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT,
                    dimensions: tuple[str, ...] = VOLUME_DIMENSIONS, first: dt.date | None = None,
                    last: dt.date | None = None) -> DataFrame:
    """Days whose volume is below ``low_percent`` or above ``high_percent`` of the
    trailing median, by dimension. A median of zero gives no verdict."""
    rows = volume_baseline(fill_days(daily_volume(day_base, dimensions), first, last), days)
    share = F.lit(100) * F.col("events")
    return rows.where((F.col("median_events") > 0) & ((share < low_percent * F.col("median_events"))
                                                      | (share > high_percent * F.col("median_events"))))


# --------------------------------------------------------------------------- spikes and dips
_PERIOD_NUMBER = (f"CAST({sx._dispatch('period_grain', 'unix_date(period_start)', 'unix_date(period_start) div 7', 'year(period_start) * 12 + month(period_start)')} AS BIGINT)")


def _twice_median(a: str) -> str:
    """Two times the median of the sorted array of longs, a whole number: both
    places are the middle one where the size is odd."""
    return f"CASE WHEN n > 0 THEN element_at({a}, CAST((n + 1) div 2 AS INT)) + element_at({a}, CAST(n div 2 + 1 AS INT)) END"


def metric_scores(dense: DataFrame, periods: int = PERIODS, min_periods: int = MIN_PERIODS, min_change: int = MIN_CHANGE,
                  z_limit: float = Z_LIMIT, mad_limit: float = MAD_LIMIT) -> DataFrame:
    """Each metric of each densified growth row beside the ``periods`` before it.

    One window per grain and segment gathers at most ``periods`` rows for a row
    (never a whole series); the median, the median of the deviations from it,
    mean and variance are computed from these. ``by_z``: the value differs from
    their mean by more than ``z_limit`` sample standard deviations; ``by_mad``:
    by more than ``mad_limit`` scaled median deviations from their median.

    With fewer than ``min_periods`` periods before it a row has no scores and no
    flags. Where the periods before are all alike, the spread is zero and any
    change of at least ``min_change`` users is flagged; a smaller one never is.
    """
    w = (Window.partitionBy("period_grain", *SEGMENTS).orderBy(F.expr(_PERIOD_NUMBER)).rangeBetween(-periods, -1))
    gathered = dense.select("period_grain", "period_start", *SEGMENTS, *GROWTH_METRICS,
                            F.collect_list(F.struct(*GROWTH_METRICS)).over(w).alias("before"))
    each = ", ".join(f"named_struct('metric', '{m}', 'value', {m}, 'w', transform(before, b -> b.{m}))" for m in GROWTH_METRICS)
    rows = gathered.selectExpr("period_grain", "period_start", *SEGMENTS, f"inline(array({each}))")
    wide = "DECIMAL(38,0)"
    # Each step's arrays are columns used twice or more by the next, so they are
    # computed once; the median reaches the deviations as an array, not inside a
    # lambda, where it would be computed again for each entry.
    rows = rows.selectExpr("*", "CAST(size(w) AS BIGINT) AS n", "array_sort(w) AS s")
    rows = rows.selectExpr(
        "*", f"{_twice_median('s')} AS m2", "aggregate(w, 0L, (s, x) -> s + x) AS total",
        f"aggregate(w, CAST(0 AS {wide}), (s, x) -> CAST(s + CAST(x AS DECIMAL(18,0)) * x AS {wide})) AS squares")
    rows = rows.selectExpr("*", "array_sort(zip_with(w, array_repeat(m2, CAST(n AS INT)), (x, m) -> abs(2 * x - m))) AS off")
    rows = rows.selectExpr("*", f"{_twice_median('off')} AS mad4")
    z10, mad10 = round(10 * z_limit) ** 2, round(10 * mad_limit)
    far = f"CAST(n * value - total AS {wide})"
    spread = f"CAST(n * squares - CAST(total AS {wide}) * total AS {wide})"
    judged = f"n >= {min_periods} AND abs(2 * value - m2) >= {2 * min_change}"
    rows = rows.selectExpr(
        "*",
        f"{judged} AND 100 * CAST({far} * {far} AS {wide}) * (n - 1) > {z10} * n * {spread} AS by_z",
        f"{judged} AND {round(20_000 * MAD_SCALE)} * abs(2 * value - m2) > {mad10} * 1000 * mad4 AS by_mad")
    known = f"n >= {min_periods}"
    return rows.selectExpr(
        "period_grain", "period_start", *SEGMENTS, "metric", "value", "n AS periods_before",
        f"CASE WHEN {known} THEN m2 / 2D END AS median", f"CASE WHEN {known} THEN mad4 / 4D END AS mad",
        f"CASE WHEN {known} THEN total / CAST(n AS DOUBLE) END AS mean",
        f"CASE WHEN {known} THEN sqrt(CAST({spread} AS DOUBLE) / (n * (n - 1))) END AS deviation",
        "by_z", "by_mad",
        "CASE WHEN by_z OR by_mad THEN CASE WHEN 2 * value > m2 THEN 'spike' ELSE 'dip' END END AS kind")


def metric_anomalies(dense: DataFrame, **limits) -> DataFrame:
    """The rows of ``metric_scores`` that either rule flags."""
    return metric_scores(dense, **limits).where("by_z OR by_mad")

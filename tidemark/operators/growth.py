"""Growth accounting: active / new / retained / resurrected / churned."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import sqlexpr as sx
from .activity import SEGMENTS, activity_window, period_window

GROWTH_KEYS = ["period_grain", "period_start", *SEGMENTS]
GROWTH_METRICS = ["active_users", "new_users", "retained_users", "resurrected_users", "churned_users"]
GROWTH_COLUMNS = GROWTH_KEYS + GROWTH_METRICS

_NEXT = sx.next_period_start("period_grain", "period_start")
_CHURNED = f"(next_active_period IS NULL OR next_active_period > {_NEXT})"


def _with_next(activity: DataFrame) -> DataFrame:
    if "next_active_period" in activity.columns:
        return activity
    return activity.withColumn("next_active_period", F.lead("period_start").over(activity_window()))


def churn_events(activity: DataFrame) -> DataFrame:
    """(grain, churn period, segment, user) for every user active in a period
    and absent in the following one."""
    return (_with_next(activity).filter(_CHURNED)
            .selectExpr("period_grain", f"{_NEXT} AS period_start", *SEGMENTS, "user_id"))


def growth_accounting(activity: DataFrame, after: dt.date | None = None,
                      upto: dt.date | None = None) -> DataFrame:
    """One row per (grain, period, segment) that has active users.

    Each activity row contributes its flags to its own period and, when the
    user is absent from the next period, one churn to that next period. A
    single aggregation (partially combined before its shuffle) therefore
    yields all five metrics: no distinct counts, no anti-join, no join back.
    Churn of a period without active users in that segment is not reported.
    """
    out = _contributions(activity, upto).filter("active_users > 0")
    return period_window(out, "period_start", after, upto).select(*GROWTH_COLUMNS)


def _contributions(activity: DataFrame, upto: dt.date | None) -> DataFrame:
    """All five metrics by (grain, period, segment), also of periods that only churn lands in."""
    own = ("named_struct('p', period_start, 'a', 1, 'n', CAST(is_new AS INT), "
           "'r', CAST(is_retained AS INT), 's', CAST(is_resurrected AS INT), 'c', 0)")
    churn = f"named_struct('p', {_NEXT}, 'a', 0, 'n', 0, 'r', 0, 's', 0, 'c', 1)"
    contrib = _with_next(activity).selectExpr(
        "period_grain", *SEGMENTS,
        f"inline(CASE WHEN {_CHURNED} THEN array({own}, {churn}) ELSE array({own}) END)")
    if upto is not None:
        contrib = contrib.filter(F.col("p") <= F.lit(upto))
    return (contrib.groupBy("period_grain", "p", *SEGMENTS)
            .agg(*[F.expr(f"CAST(sum({c}) AS BIGINT) AS {m}")
                   for c, m in zip("anrsc", GROWTH_METRICS)])
            .withColumnRenamed("p", "period_start"))


def growth_dense(activity: DataFrame, after: dt.date | None = None, upto: dt.date | None = None,
                 newest: dt.date | None = None) -> DataFrame:
    """Growth accounting without gaps: every segment has a row for each period
    from its first active one to its last, and one more where its last users
    churn, if that period isn't after the newest of the grain.

    Periods without any user have zeros, except for the churn that lands there;
    so in every row but a segment's first the users of the period before are
    those retained and those churned. There are at most as many rows as segments
    times periods between the first and the newest. Gaps are filled from one row
    to the next by a window over a segment's own (few) rows; no join. ``newest``
    is the newest day of the activity; a caller that knows it (from a partition
    listing) saves the pass that finds it.
    """
    newest = activity.agg(F.max("period_start")).scalar() if newest is None else F.lit(newest)
    if upto is not None:
        newest = F.least(newest, F.lit(upto))
    rows = _contributions(activity, upto)
    # One column for the date that bounds each grain's newest period.
    rows = rows.withColumn("newest", newest).filter(f"period_start <= {sx.period_start('period_grain', 'newest')}")
    segment = f"OVER (PARTITION BY period_grain, {', '.join(SEGMENTS)} ORDER BY period_start)"
    last = sx.prior_period_start("period_grain", "following")
    days = ", ".join(f"WHEN '{g}' THEN sequence(period_start, coalesce({last}, period_start), INTERVAL {step})"
                     for g, step in (("daily", "1 DAY"), ("weekly", "7 DAY"), ("monthly", "1 MONTH"))).replace(", WHEN", " WHEN")
    filled = (rows.selectExpr(*GROWTH_COLUMNS, f"lead(period_start) {segment} AS following")
              .selectExpr(*GROWTH_COLUMNS, f"explode(CASE period_grain {days} END) AS day"))
    zero = [f"CASE WHEN day = period_start THEN {m} ELSE 0L END AS {m}" for m in GROWTH_METRICS]
    out = filled.selectExpr("period_grain", "day AS period_start", *SEGMENTS, *zero)
    return period_window(out, "period_start", after, upto)

"""Queries of the cross-grain, volume and anomaly checks and of densified growth.

As in ``queries``: each is ``(spark, sf_dir) -> DataFrame`` over whole tables.
Faults are seeded from real rows, so that a check's count is never trivially 0.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import anomaly, quality as dq
from tidemark.operators.activity import ALL
from tidemark.operators.distinct_state import day_sketches, distinct_users, sketch_error, with_all_segments
from tidemark.operators.growth import GROWTH_COLUMNS
from tidemark.plans.distinct import distinct_days

from .queries import _summary, marts, query

SILENT_DAY = dt.date(2024, 1, 20)
BUSY_DAY = dt.date(2024, 1, 25)
BUSY_FACTOR = 4
SEEDED_DAY = dt.date(2024, 1, 8)
SEEDED_TYPES = ("click", "error", "purchase", "signup")


@query("growth_dense")
def growth_dense(spark, sf_dir):
    """Growth accounting with a row for every period between a segment's first
    and last, and for the period its last users churn in."""
    return marts(spark, sf_dir).growth_dense


@query("growth_dense_orders")
def growth_dense_orders(spark, sf_dir):
    """The same over 80 months of orders."""
    return marts(spark, sf_dir, source="orders").growth_dense


@query("dq_growth_dense")
def dq_growth_dense(spark, sf_dir):
    """On the densified mart the prior-period identity holds in every row, and
    only a segment's first row has no row before it. Seeded: without the rows of
    no active users, and with one more churned user where there are none."""
    dense = marts(spark, sf_dir).growth_dense
    return _summary([
        dq.Check("dense_prior_identity", dq.growth_prior_identity(dense)),
        dq.Check("dense_gaps", _gaps(dense)),
        dq.Check("dense_rate_bounds", dq.rate_bounds(dense)),
        dq.Check("dense_gaps_without_empty_periods", _gaps(dense.where("active_users > 0"))),
        dq.Check("dense_prior_identity_seeded", dq.growth_prior_identity(
            dense.withColumn("churned_users", F.expr("churned_users + CAST(active_users = 0 AS BIGINT)")))),
        dq.Check("dense_rate_bounds_seeded", dq.rate_bounds(
            dense.withColumn("churned_users", F.expr("churned_users + CASE WHEN period_grain = 'weekly' THEN 1000000000 ELSE 0 END")))),
    ])


def _gaps(dense: DataFrame) -> DataFrame:
    """Rows other than their segment's first whose prior period has no row."""
    from tidemark.functions import sqlexpr as sx
    w = "OVER (PARTITION BY period_grain, country, platform, utm_source ORDER BY period_start)"
    return (dense.selectExpr("*", f"lag(period_start) {w} AS before")
            .where(f"before IS NOT NULL AND before <> {sx.prior_period_start('period_grain', 'period_start')}"))


@query("dq_cross_grain")
def dq_cross_grain(spark, sf_dir):
    """Active users of every day, week and month against unions of daily bitmaps
    (and of sketches, within four times their error), and total events of weeks
    and months against their days; as they are and with seeded faults."""
    m = marts(spark, sf_dir)
    state, _ = distinct_days(spark, m.user_day_segments)
    exact = distinct_users(state)
    sketched = distinct_users(with_all_segments(day_sketches(m.user_day_segments)))
    growth, eng = m.growth_accounting, m.engagement_depth
    weekly_ios = (F.col("period_grain") == "weekly") & (F.col("platform") == "ios")
    faulty = (growth.withColumn("active_users", F.col("active_users") + F.when(weekly_ios, 1).otherwise(0))
              .filter(~((F.col("period_grain") == "monthly") & (F.col("country") == ALL))))
    lacking = eng.filter(~((F.col("period_grain") == "daily") & (F.col("platform") == "android")))
    return _summary([
        dq.Check("users", dq.cross_grain_users(growth, exact)),
        dq.Check("users_by_sketch", dq.cross_grain_users(growth, sketched, 4 * sketch_error())),
        dq.Check("users_seeded", dq.cross_grain_users(faulty, exact)),
        dq.Check("users_seeded_5_percent", dq.cross_grain_users(faulty, exact, 0.05)),
        dq.Check("users_seeded_settled", dq.cross_grain_users(faulty, exact, settled_by=SILENT_DAY)),
        dq.Check("totals", dq.cross_grain_totals(eng)),
        dq.Check("totals_seeded", dq.cross_grain_totals(lacking)),
    ])


def _seeded_days(day_base: DataFrame) -> DataFrame:
    """The base without one day, and with another day's ios events four times."""
    busy = (F.col("activity_date") == F.lit(BUSY_DAY)) & (F.col("platform") == "ios")
    return (day_base.filter(F.col("activity_date") != F.lit(SILENT_DAY))
            .withColumn("event_count", F.col("event_count") * F.when(busy, BUSY_FACTOR).otherwise(1)))


@query("volume_baseline")
def volume_baseline(spark, sf_dir):
    """Every day's events by platform, country and over all, beside the median of
    the 7 calendar days before (one day is left out of the data)."""
    base = _seeded_days(marts(spark, sf_dir).user_day_segments)
    return anomaly.volume_baseline(anomaly.fill_days(anomaly.daily_volume(base)), 7)


@query("dq_volume")
def dq_volume(spark, sf_dir):
    """Days outside 40 to 250 percent of the trailing median, by window and
    dimension; as they are, and with a silent and a busy day."""
    base = marts(spark, sf_dir).user_day_segments
    checks = []
    for name, rows in (("volume", base), ("volume_seeded", _seeded_days(base))):
        for days in anomaly.VOLUME_WINDOWS:
            found = anomaly.volume_outliers(rows, days)
            checks += [dq.Check(f"{name}_{days}_days_{d}", found.filter(F.col("dimension") == d), severity="warn")
                       for d in (ALL, *anomaly.VOLUME_DIMENSIONS)]
    return _summary(checks)


@query("metric_scores")
def metric_scores(spark, sf_dir):
    """Five growth metrics of every period and segment beside the 14 periods
    before: median, median deviation, mean, deviation and both flags."""
    return anomaly.metric_scores(marts(spark, sf_dir).growth_dense)


@query("metric_anomalies_orders")
def metric_anomalies_orders(spark, sf_dir):
    """Spikes and dips in growth over 80 months of orders."""
    return anomaly.metric_anomalies(marts(spark, sf_dir, source="orders").growth_dense)


@query("dq_metric_anomalies")
def dq_metric_anomalies(spark, sf_dir):
    """Flagged rows by metric; seeded: one day's new users ten times and another
    day's active users gone."""
    dense = marts(spark, sf_dir).growth_dense
    day = lambda d: (F.col("period_grain") == "daily") & (F.col("period_start") == F.lit(d))
    seeded = (dense.withColumn("retained_users", F.when(day(BUSY_DAY), F.col("retained_users") * 10).otherwise(F.col("retained_users")))
              .withColumn("active_users", F.when(day(SILENT_DAY), 0).otherwise(F.col("active_users"))))
    checks = []
    for name, rows in (("anomalies", dense), ("anomalies_seeded", seeded.select(*GROWTH_COLUMNS))):
        found = anomaly.metric_anomalies(rows)
        checks += [dq.Check(f"{name}_{metric}_{kind}", found.filter((F.col("metric") == metric) & (F.col("kind") == kind)), severity="warn")
                   for metric, kind in (("active_users", "dip"), ("active_users", "spike"), ("retained_users", "spike"))]
    return _summary(checks)


@query("event_mix")
def event_mix(spark, sf_dir):
    """Share of each event type in the events of every day, week and month."""
    from tidemark.operators.engagement import event_mix as mix
    return mix(marts(spark, sf_dir).fct_events)

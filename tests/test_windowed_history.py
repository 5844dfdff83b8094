"""Windowed classification equals full-history classification (events and
80 months of orders, several window boundaries)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity as act
from tidemark.operators.growth import growth_accounting
from tidemark.plans.marts import Marts
from tidemark.sources.adapters import raw_orders, raw_events

COLS = ["period_grain", "period_start", "country", "platform", "utm_source", "user_id",
        "first_active_period", "prior_period_start", "previous_active_period", "next_active_period",
        "is_new", "is_resurrected", "is_retained", "event_count"]


def rows(df, cols):
    """Order-insensitive multiset of rows (nulls allowed)."""
    from collections import Counter
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("source,after", [("events", dt.date(2024, 1, 12)),
                                          ("events", dt.date(2024, 1, 27)),
                                          ("orders", dt.date(1997, 3, 15)),
                                          ("orders", dt.date(2000, 12, 31))])
def test_classify_since_matches_full(spark, source, after):
    adapter = raw_events if source == "events" else raw_orders
    m = Marts(adapter(spark, "/root/testdata/sf0.01"))
    day = m.user_day_segments
    full = act.classify(act.user_period_segments(day)).filter(F.col("period_start") > F.lit(after))
    windowed = act.classify_since(day, after).filter(F.col("period_start") > F.lit(after))
    assert rows(windowed, COLS) == rows(full, COLS)
    g_full = growth_accounting(act.classify(act.user_period_segments(day)), after=after)
    g_win = growth_accounting(act.classify_since(day, after), after=after)
    assert rows(g_win, g_full.columns) == rows(g_full, g_full.columns)


def test_windowed_refresh_matches_full_recompute(spark):
    """Run 2 with a 5-day period lookback takes the windowed path; every
    rewritten row (period / activity period after the window start) must equal
    a full recompute over the same data, and older rows keep run-1 values."""
    from tidemark.params import RunParams
    from tidemark.plans import refresh
    from tidemark.session import scratch_path
    raw_all = raw_events(spark, "/root/testdata/sf0.01")
    b1 = raw_all.filter(F.col("event_time") < F.lit(dt.datetime(2024, 1, 21)))
    wh = scratch_path(spark, "windowed")
    refresh.refresh_all(spark, b1, wh, run_quality=False)
    w = refresh.refresh_all(spark, raw_all, wh, RunParams(period_lookback_days=5), run_quality=False).windows
    after = w["fct_growth_accounting"]
    assert after is not None and after >= dt.date(2024, 1, 14)
    full = Marts(raw_all)
    checks = {"fct_growth_accounting": (full.growth_accounting, "period_start"),
              "fct_engagement_depth": (full.engagement_depth, "period_start"),
              "user_period_activity": (full.user_period_activity, "period_start"),
              "fct_cohort_retention_triangle": (full.cohort_retention_triangle, "activity_period_start")}
    for name, (expected, col) in checks.items():
        got = refresh.read_table(spark, wh, name)
        cols = sorted(expected.columns)
        recent = lambda df: df.filter(F.col(col) > F.lit(w[name]))
        assert rows(recent(got), cols) == rows(recent(expected), cols), name
    # a day before the window keeps its run-1 numbers (no late data here, so equal as well)
    g = refresh.read_table(spark, wh, "fct_growth_accounting").filter("period_grain = 'daily'")
    assert rows(g, sorted(g.columns)) == rows(full.growth_accounting.filter("period_grain = 'daily'"),
                                              sorted(g.columns))


def test_windowed_triangle_on_long_history(spark):
    """Orders: 80 months; run 2 adds the last 5 months. The incremental
    triangle (windowed path) must equal a full rebuild."""
    from tidemark.params import RunParams
    from tidemark.plans import refresh
    from tidemark.session import scratch_path
    raw_all = raw_orders(spark, "/root/testdata/sf0.001")
    b1 = raw_all.filter(F.col("event_time") < F.lit(dt.datetime(2001, 3, 2)))
    wh = scratch_path(spark, "windowed-orders")
    refresh.refresh_all(spark, b1, wh, run_quality=False)
    w = refresh.refresh_all(spark, raw_all, wh, RunParams(period_lookback_days=62), run_quality=False).windows
    assert w["fct_cohort_retention_triangle"] is not None   # windowed path taken
    full = Marts(raw_all)
    for name, expected in (("fct_cohort_retention_triangle", full.cohort_retention_triangle),):
        got = refresh.read_table(spark, wh, name)
        assert rows(got, sorted(expected.columns)) == rows(expected, sorted(expected.columns))
    g = refresh.read_table(spark, wh, "fct_growth_accounting")
    recent = lambda df: df.filter(F.col("period_start") > F.lit(w["fct_growth_accounting"]))
    assert rows(recent(g), sorted(g.columns)) == rows(recent(full.growth_accounting), sorted(g.columns))

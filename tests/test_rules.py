"""Documented edge rules: label merging, stale partitions, null event type,
country severity, no churn row for an empty segment-period."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.params import RunParams
from tidemark.plans import refresh
from tidemark.plans.marts import Marts
from tidemark.session import scratch_path

from conftest import make_raw


def test_d5_real_unknown_merges_with_null(raw):
    m = Marts(raw([{"event_time": "2024-01-01", "user_id": "a", "platform": "Unknown"},
                   {"event_time": "2024-01-01", "user_id": "b", "platform": None}]))
    g = m.growth_accounting.filter("period_grain = 'daily' AND platform = 'unknown'").collect()
    assert len(g) == 1 and g[0].active_users == 2


def test_d10_null_event_type_is_kept(raw):
    m = Marts(raw([{"event_time": "2024-01-01", "user_id": "a", "event_type": "  "}]))
    assert [r.event_type for r in m.stg_events.collect()] == [None]


def test_d9_country_not_null_is_a_warning(raw):
    m = Marts(raw([{"event_time": "2024-01-01", "user_id": "a", "country": None}]))
    suite = dq.standard_suite(m.raw, m.stg_events, m.dim_users, m.fct_events, m.user_period_activity,
                              m.growth_accounting, m.cohort_retention_triangle, m.engagement_depth,
                              event_types=("like",))
    res = {n: (sev, f) for n, sev, f in dq.run_checks(suite)}
    assert res["stg_events_not_null_country"] == ("warn", 1)


def test_d2_no_row_for_a_segment_period_without_actives(raw):
    m = Marts(raw([{"event_time": "2024-01-01", "user_id": "a", "platform": "web"},
                   {"event_time": "2024-01-02", "user_id": "a", "platform": "ios"}]))
    web = m.growth_accounting.filter("period_grain = 'daily' AND platform = 'web'").collect()
    assert [(r.period_start, r.churned_users) for r in web] == [(dt.date(2024, 1, 1), 0)]


def test_d7_partition_without_output_is_not_deleted(spark):
    wh = scratch_path(spark, "d7")
    rows = [{"event_time": f"2024-01-0{d}", "user_id": "a"} for d in (1, 2, 3)]
    refresh.refresh_all(spark, make_raw(spark, rows), wh, run_quality=False)
    # the Jan 2 event disappears from the source; an incremental run keeps the old partition
    rows2 = [r for r in rows if r["event_time"] != "2024-01-02"]
    refresh.refresh_all(spark, make_raw(spark, rows2), wh, RunParams(period_lookback_days=0),
                        run_quality=False)
    days = {r.period_start for r in refresh.read_table(spark, wh, "fct_growth_accounting")
            .filter(F.col("period_grain") == "daily").collect()}
    assert dt.date(2024, 1, 2) in days
    refresh.refresh_all(spark, make_raw(spark, rows2), wh, RunParams(full_refresh=True), run_quality=False)
    full = refresh.read_table(spark, wh, "fct_growth_accounting").filter("period_grain = 'daily'")
    assert {r.period_start for r in full.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 3)}

"""Hand-computed growth, retention and engagement cases (FIXTURES.md section 4)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans.marts import Marts

D = dt.date


def growth_rows(m, grain, seg=("all", "all", "all")):
    g = m.growth_accounting.filter((F.col("period_grain") == grain) & (F.col("country") == seg[0])
                                   & (F.col("platform") == seg[1]) & (F.col("utm_source") == seg[2]))
    return {r.period_start: (r.active_users, r.new_users, r.retained_users, r.resurrected_users, r.churned_users)
            for r in g.collect()}


@pytest.fixture
def g1(raw):
    days = {"u1": [1, 2, 4, 6], "u2": [1], "u3": [2, 3]}
    return raw([{"event_time": f"2024-01-0{d}", "user_id": u, "platform": "web"}
                for u, ds in days.items() for d in ds])


def test_g1_daily_all_and_segment(g1):
    m = Marts(g1)
    expected = {D(2024, 1, 1): (2, 2, 0, 0, 0), D(2024, 1, 2): (2, 1, 1, 0, 1), D(2024, 1, 3): (1, 0, 1, 0, 1),
                D(2024, 1, 4): (1, 0, 0, 1, 1), D(2024, 1, 6): (1, 0, 0, 1, 0)}
    assert growth_rows(m, "daily") == expected
    assert growth_rows(m, "daily", ("UNKNOWN", "web", "unknown")) == expected


def test_g2_first_period_has_no_retained_resurrected_churned(g1):
    m = Marts(g1)
    for grain in ("daily", "weekly", "monthly"):
        rows = growth_rows(m, grain)
        first = rows[min(rows)]
        assert first[2:] == (0, 0, 0)


def test_g3_segments_classified_independently(raw):
    m = Marts(raw([{"event_time": "2024-01-01", "user_id": "u4", "platform": "web"},
                   {"event_time": "2024-01-02", "user_id": "u4", "platform": "ios"}]))
    assert growth_rows(m, "daily") == {D(2024, 1, 1): (1, 1, 0, 0, 0), D(2024, 1, 2): (1, 0, 1, 0, 0)}
    assert growth_rows(m, "daily", ("UNKNOWN", "web", "unknown")) == {D(2024, 1, 1): (1, 1, 0, 0, 0)}
    assert growth_rows(m, "daily", ("UNKNOWN", "ios", "unknown")) == {D(2024, 1, 2): (1, 1, 0, 0, 0)}


def test_g4_leap_month(raw):
    m = Marts(raw([{"event_time": d, "user_id": "u5"} for d in ("2024-01-31", "2024-02-29", "2024-03-01")]))
    monthly = growth_rows(m, "monthly")
    assert monthly == {D(2024, 1, 1): (1, 1, 0, 0, 0), D(2024, 2, 1): (1, 0, 1, 0, 0), D(2024, 3, 1): (1, 0, 1, 0, 0)}
    weekly = growth_rows(m, "weekly")
    assert weekly[D(2024, 1, 29)][1] == 1 and weekly[D(2024, 2, 26)][3] == 1
    daily = growth_rows(m, "daily")
    assert daily[D(2024, 1, 31)][1] == 1 and daily[D(2024, 2, 29)][3] == 1 and daily[D(2024, 3, 1)][2] == 1


def test_g7_triangle(raw):
    days = {"u1": [1, 2, 4], "u2": [1], "u3": [2, 3]}
    m = Marts(raw([{"event_time": f"2024-01-0{d}", "user_id": u} for u, ds in days.items() for d in ds]))
    t = m.cohort_retention_triangle.filter("cohort_grain = 'daily' AND country = 'all'")
    got = {(r.cohort_start.day, r.period_index): (r.cohort_users, r.retained_users, r.retention_rate)
           for r in t.collect()}
    assert got == {(1, 0): (2, 2, 1.0), (1, 1): (2, 1, 0.5), (1, 3): (2, 1, 0.5),
                   (2, 0): (1, 1, 1.0), (2, 1): (1, 1, 1.0)}


def test_g8_engagement(raw):
    rows = [{"event_time": "2024-01-01", "user_id": "u1", "miles_amount": v} for v in (10.0, None, 5.0)]
    rows.append({"event_time": "2024-01-01", "user_id": "u2", "miles_amount": None})
    # distinct times so the four events are distinct
    for i, r in enumerate(rows):
        r["event_time"] = f"2024-01-01 0{i}:00:00"
    m = Marts(raw(rows))
    e = m.engagement_depth.filter("period_grain = 'daily' AND country = 'all'").first()
    assert (e.total_events, e.active_users, e.events_per_active_user, e.avg_miles_per_active_user,
            e.power_users, e.power_user_share) == (4, 2, 2.0, 7.5, 1, 0.5)


def test_g9_power_across_segments(raw):
    rows = [{"event_time": f"2024-01-01 0{i}:00:00", "user_id": "u", "platform": p}
            for i, p in enumerate(["web", "web", "ios"])]
    m = Marts(raw(rows))
    e = {(r.platform): r.power_users for r in
         m.engagement_depth.filter("period_grain = 'daily'").collect()}
    assert e == {"all": 1, "web": 0, "ios": 0}


def test_set_algebra_oracle(raw):
    """Independent check of the window classification with DataFrame set ops
    (intersect / subtract over user sets) on a random-ish history."""
    import random
    rnd = random.Random(7)
    rows = [{"event_time": f"2024-0{rnd.randint(1, 3)}-{rnd.randint(1, 28):02d}", "user_id": f"u{rnd.randint(1, 25)}"}
            for _ in range(400)]
    m = Marts(raw(rows))
    act = m.user_period_activity.filter("period_grain = 'weekly' AND country = 'all'")
    periods = sorted({r.period_start for r in act.select("period_start").distinct().collect()})
    users = lambda p: act.filter(F.col("period_start") == p).select("user_id")
    growth = growth_rows(m, "weekly")
    for p in periods:
        prev = p - dt.timedelta(days=7)
        cur = users(p)
        before = act.filter(F.col("period_start") < prev).select("user_id")
        retained = cur.intersect(users(prev)).count()
        churned = users(prev).subtract(cur).count()
        resurrected = cur.subtract(users(prev)).intersect(before).count()
        assert growth[p][2:] == (retained, resurrected, churned)

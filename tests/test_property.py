"""Property test: growth accounting equals a brute-force evaluation of the
metric contract's set definitions on random small histories."""
import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.plans.marts import Marts

from conftest import make_raw

BASE = dt.date(2024, 1, 1)
PLATFORMS = ["ios", "web", None]


def period_of(grain, d):
    if grain == "daily":
        return d
    if grain == "weekly":
        return d - dt.timedelta(days=d.weekday())
    return d.replace(day=1)


def prior_of(grain, p):
    if grain == "daily":
        return p - dt.timedelta(days=1)
    if grain == "weekly":
        return p - dt.timedelta(days=7)
    return (p - dt.timedelta(days=1)).replace(day=1)


def brute_force(events):
    """{(grain, period, platform_label): (active, new, retained, resurrected, churned)}"""
    out = {}
    for grain in ("daily", "weekly", "monthly"):
        sets = defaultdict(lambda: defaultdict(set))
        for user, d, platform in events:
            p = period_of(grain, d)
            sets[platform or "unknown"][p].add(user)
            sets["all"][p].add(user)
        for seg, by_period in sets.items():
            first = {}
            for p in sorted(by_period):
                for u in by_period[p]:
                    first.setdefault(u, p)
            for p, active in by_period.items():
                prev = by_period.get(prior_of(grain, p), set())
                before = set().union(*[s for q, s in by_period.items() if q < prior_of(grain, p)])
                new = {u for u in active if first[u] == p}
                out[(grain, p, seg)] = (len(active), len(new), len(active & prev),
                                        len((active - prev) & before), len(prev - active))
    return out


event = st.tuples(st.sampled_from(["u1", "u2", "u3", "u4"]), st.integers(0, 75), st.sampled_from(PLATFORMS))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25))
def test_growth_matches_set_definitions(spark, evs):
    events = [(u, BASE + dt.timedelta(days=k), p) for u, k, p in evs]
    raw = make_raw(spark, [{"event_time": f"{d.isoformat()} 10:{i % 60:02d}:00", "user_id": u, "platform": p}
                           for i, (u, d, p) in enumerate(events)])
    got = {(r.period_grain, r.period_start, r.platform):
           (r.active_users, r.new_users, r.retained_users, r.resurrected_users, r.churned_users)
           for r in Marts(raw).growth_accounting.collect()}
    assert got == brute_force(events)


def brute_force_triangle(events):
    """{(grain, cohort, activity, segment): (index, cohort_users, retained)}"""
    out = {}
    for grain in ("daily", "weekly", "monthly"):
        sets = defaultdict(lambda: defaultdict(set))
        for user, d, platform in events:
            p = period_of(grain, d)
            sets[platform or "unknown"][p].add(user)
            sets["all"][p].add(user)
        for seg, by_period in sets.items():
            first = {}
            for p in sorted(by_period):
                for u in by_period[p]:
                    first.setdefault(u, p)
            size = defaultdict(int)
            for u, c in first.items():
                size[c] += 1
            cells = defaultdict(int)
            for p, users in by_period.items():
                for u in users:
                    cells[(first[u], p)] += 1
            for (c, p), n in cells.items():
                if grain == "daily":
                    idx = (p - c).days
                elif grain == "weekly":
                    idx = (p - c).days // 7
                else:
                    idx = (p.year - c.year) * 12 + p.month - c.month
                out[(grain, c, p, seg)] = (idx, size[c], n)
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25))
def test_triangle_matches_brute_force(spark, evs):
    events = [(u, BASE + dt.timedelta(days=k), p) for u, k, p in evs]
    raw = make_raw(spark, [{"event_time": f"{d.isoformat()} 10:{i % 60:02d}:00", "user_id": u, "platform": p}
                           for i, (u, d, p) in enumerate(events)])
    got = {(r.cohort_grain, r.cohort_start, r.activity_period_start, r.platform):
           (r.period_index, r.cohort_users, r.retained_users)
           for r in Marts(raw).cohort_retention_triangle.collect()}
    assert got == brute_force_triangle(events)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=30), st.integers(0, 75))
def test_windowed_classification_matches_full(spark, evs, cut):
    from pyspark.sql import functions as F

    from tidemark.operators import activity as act
    events = [(u, BASE + dt.timedelta(days=k), p) for u, k, p in evs]
    raw = make_raw(spark, [{"event_time": f"{d.isoformat()} 10:{i % 60:02d}:00", "user_id": u, "platform": p}
                           for i, (u, d, p) in enumerate(events)])
    day = Marts(raw).user_day_segments
    after = BASE + dt.timedelta(days=cut)
    cols = ["period_grain", "period_start", "platform", "user_id", "first_active_period",
            "previous_active_period", "next_active_period", "is_new", "is_retained", "is_resurrected"]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    full = act.classify(act.user_period_segments(day)).filter(F.col("period_start") > F.lit(after))
    win = act.classify_since(day, after).filter(F.col("period_start") > F.lit(after))
    assert sorted(map(tuple, win.select(*cols).collect()), key=key) == \
        sorted(map(tuple, full.select(*cols).collect()), key=key)

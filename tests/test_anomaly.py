"""Volume, spikes and dips, densified growth and distinct state on small cases."""
import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark import Marts
from tidemark.operators import anomaly, quality as dq
from tidemark.operators.distinct_state import BLOCK_USERS, day_bitmaps, day_sketches, distinct_users, sketch_error, with_all_segments
from tidemark.operators.growth import GROWTH_COLUMNS, GROWTH_METRICS
from tidemark.plans import distinct

D = dt.date
BASE = "activity_date date, user_id string, country string, platform string, utm_source string, event_count long"


def base(spark, counts, platform="ios", country="SG"):
    """A daily base with one user row per day."""
    return spark.createDataFrame([(d, "u", country, platform, "x", n) for d, n in counts.items()], BASE)


def days(first, n):
    return [first + dt.timedelta(days=i) for i in range(n)]


def test_a_day_without_events_is_a_day_of_zero(spark):
    d = days(D(2024, 1, 1), 16)
    counts = {x: 100 for x in d if x not in (d[8], d[10])}
    rows = {r.activity_date: r for r in anomaly.volume_baseline(anomaly.fill_days(anomaly.daily_volume(base(spark, counts))), 7)
            .where("dimension = 'all'").collect()}
    assert len(rows) == 16 and rows[d[8]].events == 0
    assert [rows[x].median_events for x in d[:7]] == [None] * 7
    assert rows[d[7]].median_events == rows[d[11]].median_events == 100
    low = anomaly.volume_outliers(base(spark, counts), 7)
    assert {(r.dimension, r.activity_date) for r in low.collect()} == {(x, y) for x in ("all", "platform", "country") for y in (d[8], d[10])}


def test_zeros_count_in_the_median_and_a_zero_median_gives_no_verdict(spark):
    d = days(D(2024, 1, 1), 9)
    counts = {d[0]: 4, d[1]: 8, d[2]: 6, d[7]: 1000, d[8]: 1}   # four empty days
    rows = anomaly.volume_baseline(anomaly.fill_days(anomaly.daily_volume(base(spark, counts))), 7).where("dimension = 'all'")
    got = {r.activity_date: r.median_events for r in rows.collect()}
    assert got[d[7]] == 0 and got[d[8]] == 0
    assert anomaly.volume_outliers(base(spark, counts), 7).count() == 0


def test_volume_bounds_are_exclusive_and_localized(spark):
    d = days(D(2024, 2, 1), 9)
    both = base(spark, {x: 100 for x in d}).unionByName(
        base(spark, {x: 100 if x < d[7] else (40 if x == d[7] else 39) for x in d}, "web", "MY"))
    got = {(r.dimension, r.value, r.activity_date) for r in anomaly.volume_outliers(both, 7).collect()}
    assert got == {("platform", "web", d[8]), ("country", "MY", d[8])}
    high = base(spark, {x: 100 if x < d[7] else (250 if x == d[7] else 251) for x in d})
    assert {r.activity_date for r in anomaly.volume_outliers(high, 7).where("dimension = 'all'").collect()} == {d[8]}
    assert anomaly.volume_outliers(high, 14).count() == 0   # no 14 days have passed
    longer = anomaly.volume_outliers(base(spark, {x: 100 for x in d}), 7, last=d[8] + dt.timedelta(days=1))
    assert {r.activity_date for r in longer.collect()} == {d[8] + dt.timedelta(days=1)}   # nothing arrived on the run's day


def dense_series(spark, values, first=D(2024, 1, 1), grain="daily", step=1):
    rows = [(grain, first + dt.timedelta(days=step * i), "SG", "ios", "x", *([v] + [0] * 4)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "period_grain string, period_start date, country string, platform string, utm_source string, "
                                 + ", ".join(f"{m} long" for m in GROWTH_METRICS))


def scores(spark, values, **kw):
    rows = anomaly.metric_scores(dense_series(spark, values), **kw).where("metric = 'active_users'").collect()
    return sorted(rows, key=lambda r: r.period_start)


def test_constant_and_short_series(spark):
    got = scores(spark, [20] * 10 + [24, 25])
    assert not any(r.by_z or r.by_mad for r in got[:11])      # a change of four is below min_change
    assert got[11].by_z is True and got[11].by_mad is True and got[11].kind == "spike"
    short = scores(spark, [20] * 6 + [900])
    assert all(not r.by_z and not r.by_mad and r.median is None and r.deviation is None for r in short)
    assert scores(spark, [7])[0].periods_before == 0


def test_scores_equal_plain_statistics(spark):
    rng = random.Random(4)
    values = [rng.choice([0, 3, 50, 60, 61, 70, 400]) for _ in range(60)]
    for r, i in zip(scores(spark, values, periods=9, min_periods=4, z_limit=1.5, mad_limit=2.0), range(60)):
        w = values[max(0, i - 9):i]
        assert r.periods_before == len(w)
        if len(w) < 4:
            assert not r.by_z and not r.by_mad
            continue
        med = statistics.median(w)
        mad = statistics.median(abs(x - med) for x in w)
        mean, sd = statistics.fmean(w), statistics.stdev(w)
        assert (r.median, r.mad) == (med, mad)
        assert r["mean"] == pytest.approx(mean) and r.deviation == pytest.approx(sd)
        big = abs(values[i] - med) >= 5
        assert r.by_z == (big and abs(values[i] - mean) > 1.5 * sd)
        assert r.by_mad == (big and 0.6745 * abs(values[i] - med) > 2.0 * mad)


def test_windows_are_calendar_ranges_in_every_grain(spark):
    for grain, starts in (("weekly", [D(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(9)]),
                          ("monthly", [D(2023 + i // 12, i % 12 + 1, 1) for i in range(9)])):
        rows = [(grain, p, "SG", "ios", "x", i, 0, 0, 0, 0) for i, p in enumerate(starts) if i != 4]
        df = spark.createDataFrame(rows, dense_series(spark, [1]).schema)
        got = {r.period_start: r.periods_before for r in anomaly.metric_scores(df, periods=3).where("metric = 'active_users'").collect()}
        assert [got[p] for i, p in enumerate(starts) if i != 4] == [0, 1, 2, 3, 2, 2, 2, 3]


def dense_of(raw, events):
    m = Marts(raw([{"event_time": t, "user_id": u, "country": c} for t, u, c in events]))
    return m, {(r.period_grain, str(r.period_start), r.country): tuple(r[x] for x in GROWTH_METRICS)
               for r in m.growth_dense.collect()}


def test_empty_periods_get_rows_and_their_churn(spark, raw):
    m, got = dense_of(raw, [("2024-01-01", "a", "SG"), ("2024-01-05", "a", "SG"), ("2024-01-08", "z", "MY")])
    sg = {k[1]: v for k, v in got.items() if k[0] == "daily" and k[2] == "SG"}
    assert sg == {"2024-01-01": (1, 1, 0, 0, 0), "2024-01-02": (0, 0, 0, 0, 1), "2024-01-03": (0, 0, 0, 0, 0),
                  "2024-01-04": (0, 0, 0, 0, 0), "2024-01-05": (1, 0, 0, 1, 0), "2024-01-06": (0, 0, 0, 0, 1)}
    assert ("daily", "2024-01-09", "MY") not in got          # after the newest day
    assert got[("weekly", "2024-01-08", "SG")] == (0, 0, 0, 0, 1)
    assert ("monthly", "2024-02-01", "SG") not in got
    assert dq.growth_prior_identity(m.growth_dense).count() == 0
    assert dq.rate_bounds(m.growth_dense).count() == 0
    from tidemark.operators.growth import growth_dense
    known = growth_dense(m.activity, newest=D(2024, 1, 8))
    assert known.exceptAll(m.growth_dense).count() == m.growth_dense.exceptAll(known).count() == 0
    # where the sparse mart has a row, both agree
    sparse = m.growth_accounting
    assert sparse.select(*GROWTH_COLUMNS).exceptAll(m.growth_dense.select(*GROWTH_COLUMNS)).count() == 0


def test_months_are_filled_across_years(spark, raw):
    _, got = dense_of(raw, [("2023-10-31", "a", "SG"), ("2024-02-29", "a", "SG")])
    months = {k[1]: v for k, v in got.items() if k[0] == "monthly" and k[2] == "SG"}
    assert months == {"2023-10-01": (1, 1, 0, 0, 0), "2023-11-01": (0, 0, 0, 0, 1), "2023-12-01": (0,) * 5,
                      "2024-01-01": (0,) * 5, "2024-02-01": (1, 0, 0, 1, 0)}


def random_base(spark, users, n_days, seed):
    rng = random.Random(seed)
    rows = {(D(2024, 1, 1) + dt.timedelta(days=rng.randrange(n_days)), f"u{rng.randrange(users)}", rng.choice(["SG", "MY"]),
             rng.choice(["ios", "web"]), "x") for _ in range(users * 4)}
    return spark.createDataFrame([(*r, 1) for r in sorted(rows)], BASE)


def test_bitmaps_give_distinct_users_of_every_grain(spark):
    df = random_base(spark, 300, 70, 2).repartition(5)
    numbers, path = distinct.number_users(spark, distinct.users_of(df), ("country",), start=BLOCK_USERS - 100)   # over two blocks
    got = sorted(r.user_number for r in numbers.collect())
    assert got == list(range(BLOCK_USERS - 100, BLOCK_USERS - 100 + len(got))) and len(got) == df.select("user_id").distinct().count()
    state = with_all_segments(day_bitmaps(df, numbers))
    counted = {tuple(r)[:5]: r.distinct_users for r in distinct_users(state).collect()}
    users = {}
    for r in df.collect():
        d = r.activity_date
        for g, p in (("daily", d), ("weekly", d - dt.timedelta(days=d.weekday())), ("monthly", d.replace(day=1))):
            for seg in ((r.country, r.platform, r.utm_source), ("all",) * 3):
                users.setdefault((g, p, *seg), set()).add(r.user_id)
    assert counted == {k: len(v) for k, v in users.items()}
    by_sketch = {tuple(r)[:5]: r.distinct_users for r in distinct_users(with_all_segments(day_sketches(df))).collect()}
    assert all(abs(by_sketch[k] - n) <= 4 * sketch_error() * n + 0.5 for k, n in counted.items())


def test_no_user_row_is_read_for_a_grain(spark):
    df = random_base(spark, 50, 10, 3)
    numbers, _ = distinct.number_users(spark, distinct.users_of(df))
    plan = distinct_users(with_all_segments(day_bitmaps(df, numbers)))._jdf.queryExecution().optimizedPlan().toString()
    top = plan[:plan.index("bitmap_construct_agg")]
    assert "user_id" not in top     # above the day state there are only bitmaps


def test_stored_state_follows_touched_days(spark, tmp_path):
    wh = str(tmp_path)
    first, later = random_base(spark, 80, 12, 5), random_base(spark, 140, 20, 6)
    distinct.refresh_distinct(spark, wh, first, None)
    numbers = {r.user_id: r.user_number for r in spark.read.parquet(f"{wh}/user_numbers").collect()}
    both = first.filter("activity_date < DATE '2024-01-10'").unionByName(later.filter("activity_date >= DATE '2024-01-10'"))
    distinct.refresh_distinct(spark, wh, both, dt.datetime(2024, 1, 10, 5))
    distinct.refresh_distinct(spark, wh, both, dt.datetime(2024, 1, 10, 5))   # repeated, as after a crash
    again = spark.read.parquet(f"{wh}/user_numbers").collect()
    assert {r.user_id: r.user_number for r in again if r.user_id in numbers} == numbers
    assert sorted(r.user_number for r in again) == list(range(len(again)))
    whole, _ = distinct.distinct_days(spark, both)
    keys = ["period_grain", "period_start", "country", "platform", "utm_source", "distinct_users"]
    a = distinct_users(distinct.stored_distinct(spark, wh)).select(*keys)
    b = distinct_users(whole).select(*keys)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_cross_grain_sees_what_differs(spark, raw):
    m = Marts(raw([{"event_time": f"2024-01-{d:02d}", "user_id": u, "platform": "ios", "country": "SG"}
                   for d in range(1, 20) for u in ("a", "b", "c") if (d + ord(u)) % 3]))
    state, _ = distinct.distinct_days(spark, m.user_day_segments)
    exact = distinct_users(state)
    g = m.growth_accounting
    assert dq.cross_grain_users(g, exact).count() == 0
    off = g.withColumn("active_users", F.expr("active_users + CAST(period_grain = 'weekly' AND country = 'all' AS BIGINT)"))
    weeks = g.filter("period_grain = 'weekly' AND country = 'all'").count()
    assert dq.cross_grain_users(off, exact).count() == weeks
    assert dq.cross_grain_users(off, exact, tolerance=0.4).count() == 0
    assert dq.cross_grain_users(off, exact, settled_by=D(2024, 1, 15)).count() == 2
    assert dq.cross_grain_users(g.filter("period_grain <> 'monthly'"), exact).count() == 2
    eng = m.engagement_depth
    assert dq.cross_grain_totals(eng).count() == 0
    assert dq.cross_grain_totals(eng.filter("period_start <> DATE '2024-01-02' OR period_grain <> 'daily'")).count() == 4

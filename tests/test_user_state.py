"""The stored user state: advanced, reused, and dropped when days before it change."""
import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity as act
from tidemark.params import RunParams
from tidemark.plans import refresh
from tidemark.session import scratch_path

D = dt.date
START = D(2023, 1, 1)
BASE = "activity_date date, user_id string, country string, platform string, utm_source string, event_count long, miles_sum decimal(38,9)"


@pytest.fixture(scope="module")
def day_base(spark, tmp_path_factory):
    """400 days of some regular, some rare users, as a stored table."""
    rng = random.Random(8)
    rows = {(START + dt.timedelta(days=d), f"u{u}", rng.choice(["SG", "MY"]), "ios", "x")
            for u in range(40) for d in range(400) if rng.random() < (0.2 if u % 2 else 0.01)}
    path = str(tmp_path_factory.mktemp("base"))
    spark.createDataFrame([(*r, 1, None) for r in sorted(rows)], BASE).repartition("activity_date").write.partitionBy("activity_date") \
        .mode("overwrite").parquet(path)
    return spark.read.parquet(path)


COLS = ["period_grain", "period_start", "country", "platform", "utm_source", "user_id", "first_active_period",
        "previous_active_period", "next_active_period", "is_new", "is_resurrected", "is_retained", "event_count"]


def rows(df, cols=COLS):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def full_after(day_base, after):
    return rows(act.classify(act.user_period_segments(day_base)).filter(F.col("period_start") > F.lit(after)))


@pytest.mark.parametrize("lag", [31, 40, 61, 200])
def test_any_older_state_gives_the_flags_of_full_history(day_base, lag):
    after = D(2023, 12, 20)
    as_of = after - dt.timedelta(days=lag)
    got = act.classify_since(day_base, after, state=act.user_state(day_base, as_of), as_of=as_of)
    assert rows(got.filter(F.col("period_start") > F.lit(after))) == full_after(day_base, after)


def test_a_state_that_is_too_recent_is_refused(day_base):
    with pytest.raises(ValueError):
        act.classify_since(day_base, D(2023, 12, 20), state=day_base, as_of=D(2023, 12, 1))


def test_advancing_equals_rebuilding(day_base):
    a, b = D(2023, 5, 1), D(2023, 9, 9)
    cols = [*act.STATE_KEYS, "first_day", "last_day"]
    assert rows(act.advance_user_state(act.user_state(day_base, a), day_base, a, b), cols) == rows(act.user_state(day_base, b), cols)


def test_an_incremental_plan_reads_the_days_since_the_state_only(spark, day_base):
    as_of = D(2023, 10, 1)
    path = scratch_path(spark, "state")
    act.user_state(day_base, as_of).write.parquet(path)
    df = act.classify_since(day_base, D(2023, 12, 20), state=spark.read.parquet(path), as_of=as_of)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert len(scans) == 2 and sum("activity_date" in x and "> 2023-10-01" in x for x in scans) == 1
    assert plan.count("Exchange hashpartitioning(user_id") == 1 and "Join" not in plan


def test_versions(spark, day_base):
    wh = scratch_path(spark, "versions")

    def take(boundary, changed):
        state, as_of = refresh.stored_state(spark, wh, day_base, boundary, changed)
        assert rows(state, [*act.STATE_KEYS, "first_day", "last_day"]) == rows(
            act.user_state(day_base, as_of), [*act.STATE_KEYS, "first_day", "last_day"])
        return as_of, refresh.state_versions(spark, wh)
    late = D(2024, 1, 1)
    assert take(D(2023, 3, 1), late) == (D(2023, 3, 1), [D(2023, 3, 1)])
    assert take(D(2023, 3, 20), late) == (D(2023, 3, 1), [D(2023, 3, 1)])                          # within the stride
    assert take(D(2023, 6, 1), late) == (D(2023, 6, 1), [D(2023, 3, 1), D(2023, 6, 1)])            # advanced, one kept
    assert take(D(2023, 9, 1), late) == (D(2023, 9, 1), [D(2023, 6, 1), D(2023, 9, 1)])
    assert take(D(2023, 7, 1), D(2023, 8, 5)) == (D(2023, 6, 1), [D(2023, 6, 1)])                  # August changed: September's is stale
    assert take(D(2023, 2, 1), D(2023, 5, 5)) == (D(2023, 2, 1), [D(2023, 2, 1)])                  # nothing usable: rebuilt
    os.remove(os.path.join(refresh.state_path(wh, D(2023, 2, 1)), "_SUCCESS"))
    os.makedirs(os.path.join(refresh.state_path(wh, D(2023, 2, 1)), "_temporary"))                 # a version that was cut off
    assert refresh.state_versions(spark, wh) == []
    assert take(D(2023, 2, 1), late) == (D(2023, 2, 1), [D(2023, 2, 1)])


def test_runs_over_a_year_equal_a_rebuild(spark, day_base):
    """Deliveries months apart; the state moves on between them."""
    from tidemark.operators.engagement import engagement_depth
    from tidemark.operators.growth import growth_accounting
    from tidemark.operators.retention import cohort_retention_triangle
    from tidemark.plans import sinks
    weekly = day_base.filter(F.dayofweek("activity_date") == 2)
    wh, p = scratch_path(spark, "year"), RunParams(period_lookback_days=40)
    seen, before = [], None
    for day in (D(2023, 7, 1), D(2023, 11, 1), D(2024, 12, 31)):
        sinks.replace(weekly.filter(F.col("activity_date") < F.lit(day)), refresh.table_path(wh, refresh.DAY_BASE), "activity_date")
        refresh.refresh_periods(spark, wh, p, changed_since=before and dt.datetime.combine(before, dt.time()) - dt.timedelta(days=1))
        seen.append(refresh.state_versions(spark, wh))
        before = day
    assert seen[0] and max(seen[0]) < max(seen[1]) < max(seen[2])
    periods = act.user_period_segments(weekly)
    activity = act.classify(periods)
    whole = {"user_period_activity": act.user_period_activity(activity), "fct_growth_accounting": growth_accounting(activity),
             "fct_engagement_depth": engagement_depth(periods), "fct_cohort_retention_triangle": cohort_retention_triangle(activity)}
    for t, expected in whole.items():
        assert rows(refresh.read_table(spark, wh, t), expected.columns) == rows(expected, expected.columns), t

"""Each check passes on clean marts and reports a seeded fault (G14, G15)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.plans.marts import Marts

from conftest import make_raw


@pytest.fixture(scope="module")
def clean(spark):
    rows = [{"event_time": f"2024-01-{d:02d} 1{i}:00:00", "user_id": u, "platform": p,
             "event_type": "like", "country": "sg", "miles_amount": 1.0}
            for d in range(1, 15) for i, (u, p) in enumerate([("a", "ios"), ("b", "web"), ("c", "ios")])
            if (d + i) % 3]
    return make_raw(spark, rows)


def count(df):
    return df.count()


def test_clean_suite_passes(clean):
    m = Marts(clean)
    suite = dq.standard_suite(clean, m.stg_events, m.dim_users, m.fct_events, m.user_period_activity,
                              m.growth_accounting, m.cohort_retention_triangle, m.engagement_depth,
                              execution_date="2024-01-05", event_types=("like",))
    res = dq.run_checks(suite)
    assert all(f == 0 for _, _, f in res), [r for r in res if r[2]]


def test_g14_duplicate_signature(spark, clean):
    dup = clean.unionByName(clean.limit(1).withColumn("gender", F.lit("X")))
    assert count(dq.source_duplicates(dup)) == 1
    m = Marts(dup)
    assert count(dq.unique(m.stg_events, "event_id")) == 1


def test_g15_each_check_sees_its_fault(spark, clean):
    m = Marts(clean)
    g = m.growth_accounting
    bump = lambda col, cond: g.withColumn(col, F.when(cond, F.col(col) + 1).otherwise(F.col(col)))
    top = (F.col("country") == "all") & (F.col("period_start") == F.lit(dt.date(2024, 1, 5)))
    top = top & (F.col("period_grain") == "daily")
    assert count(dq.growth_identity(bump("new_users", top), topline_only=True)) == 1
    assert count(dq.growth_identity(bump("new_users", top))) == 1
    assert count(dq.growth_prior_identity(bump("churned_users", top), topline_only=True)) == 1
    neg = g.withColumn("churned_users", F.when(top, F.lit(-1)).otherwise(F.col("churned_users")))
    assert count(dq.growth_non_negative(neg, topline_only=True)) == 1
    a = m.user_period_activity.withColumn("is_retained", F.col("is_new"))
    assert count(dq.classification_exclusive(a)) > 0
    t = m.cohort_retention_triangle
    assert count(dq.triangle_bounds(t.withColumn("retention_rate", F.lit(1.5)))) == t.count()
    assert count(dq.triangle_unique(t.unionByName(t.limit(1)))) == 1
    e = m.engagement_depth
    assert count(dq.engagement_bounds(e.withColumn("power_users", F.col("active_users") + 1))) == e.count()
    bad_dim = m.dim_users.withColumn("first_event_time_utc", F.col("first_event_time_utc") + F.expr("INTERVAL 1 SECOND"))
    assert count(dq.dim_first_event(bad_dim, m.fct_events)) == 3
    rel = dq.relationships(m.fct_events, "user_id", m.dim_users.filter("user_id <> 'a'"), "user_id")
    assert [r.n_records for r in rel.collect()] == [m.fct_events.filter("user_id = 'a'").count()]
    assert dq.summarize([dq.Check("rel", rel, weighted=True)]).first().failures == rel.first().n_records
    assert count(dq.accepted_values(m.stg_events, "event_type", ("share",))) == m.stg_events.count()
    assert count(dq.source_availability(clean, "2024-03-01")) == 1
    assert count(dq.source_availability(clean, "2024-01-02")) == 0
    nulls = {r.column_name: r.failures for r in dq.null_counts(m.stg_events, ["gender", "user_id"]).collect()}
    assert nulls == {"gender": m.stg_events.count(), "user_id": 0}
    with pytest.raises(dq.DataQualityError):
        dq.run_checks([dq.Check("growth_identity", dq.growth_identity(bump("new_users", top)))])

"""Incremental runs: upsert / partition overwrite, lookback and cutoff rules."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.params import RunParams
from tidemark.plans import refresh, sinks
from tidemark.plans.marts import Marts
from tidemark.session import scratch_path

from conftest import make_raw


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_g11_lookback_is_strict(spark):
    wh = scratch_path(spark, "g11")
    b1 = make_raw(spark, [{"event_time": "2024-01-10 12:00:00", "user_id": "a"}])
    refresh.refresh_events(spark, b1, wh)
    late = make_raw(spark, [{"event_time": "2024-01-09 12:00:00", "user_id": "b"},
                            {"event_time": "2024-01-09 12:00:00.000001", "user_id": "c"}])
    refresh.refresh_events(spark, b1.unionByName(late), wh)
    users = {r.user_id for r in refresh.read_table(spark, wh, "fct_events").collect()}
    assert users == {"a", "c"}


def test_g12_cutoff_is_inclusive(raw):
    df = raw([{"event_time": "2024-01-10 00:00:00", "user_id": "a"},
              {"event_time": "2024-01-10 00:00:01", "user_id": "b"}])
    m = Marts(df, RunParams(execution_date="2024-01-10 00:00:00"))
    assert {r.user_id for r in m.fct_events.collect()} == {"a"}
    m2 = Marts(df, RunParams(execution_date="2024-01-10"))
    assert {r.user_id for r in m2.fct_events.collect()} == {"a"}


def test_g10_latest_non_null_and_merge(spark):
    wh = scratch_path(spark, "g10")
    b1 = make_raw(spark, [{"event_time": "2024-01-01 01:00:00", "user_id": "u", "gender": "F", "platform": "ios"}])
    refresh.refresh_events(spark, b1, wh)
    b2 = b1.unionByName(make_raw(spark, [{"event_time": "2024-01-01 02:00:00", "user_id": "u",
                                           "gender": None, "platform": "web"}]))
    refresh.refresh_events(spark, b2, wh)
    d = refresh.read_table(spark, wh, "dim_users").collect()
    assert len(d) == 1
    assert (d[0].latest_gender, d[0].latest_platform) == ("F", "web")
    assert d[0].first_event_time_utc == dt.datetime(2024, 1, 1, 1)
    assert d[0].latest_event_time_utc == dt.datetime(2024, 1, 1, 2)


def test_two_batches_equal_full_refresh_and_rerun_is_noop(spark):
    sf = "/root/testdata/sf0.001"
    from tidemark.sources.adapters import raw_events
    raw_all = raw_events(spark, sf)
    b1 = raw_all.filter(F.col("event_time") <= F.lit(dt.datetime(2024, 1, 20)))
    wh = scratch_path(spark, "two-batch")
    refresh.refresh_all(spark, b1, wh, run_quality=False)
    refresh.refresh_all(spark, raw_all, wh, run_quality=True,
                        event_types=("click", "error", "purchase", "signup", "view"))
    full = Marts(raw_all)
    for name, expected in (("fct_events", full.fct_events), ("dim_users", full.dim_users),
                           ("fct_growth_accounting", full.growth_accounting),
                           ("fct_cohort_retention_triangle", full.cohort_retention_triangle),
                           ("fct_engagement_depth", full.engagement_depth),
                           ("user_period_activity", full.user_period_activity)):
        got = refresh.read_table(spark, wh, name)
        assert rows_of(got, sorted(expected.columns)) == rows_of(expected), name
    before = rows_of(refresh.read_table(spark, wh, "fct_growth_accounting"))
    refresh.refresh_all(spark, raw_all, wh, run_quality=False)
    assert rows_of(refresh.read_table(spark, wh, "fct_growth_accounting")) == before


def test_upsert_rejects_duplicate_keys(spark):
    path = scratch_path(spark, "dup")
    df = spark.createDataFrame([("k", dt.date(2024, 1, 1), 1), ("k", dt.date(2024, 1, 1), 2)],
                               "id string, d date, v int")
    sinks.replace(df.limit(1), path, "d")
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.upsert(spark, path, df, "id", "d")


def test_upsert_replaces_matched_and_inserts_new(spark):
    path = scratch_path(spark, "ups")
    D = dt.date
    base = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 2), 1)], "id string, d date, v int")
    sinks.replace(base, path, "d")
    inc = spark.createDataFrame([("a", D(2024, 1, 1), 9), ("c", D(2024, 1, 3), 1)], "id string, d date, v int")
    sinks.upsert(spark, path, inc, "id", "d")
    got = sorted((r.id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 9), ("b", 1), ("c", 1)]


def test_precheck_scope_window_only_sees_recent_duplicates(spark):
    from tidemark.operators.quality import DataQualityError
    wh = scratch_path(spark, "scope")
    old = make_raw(spark, [{"event_time": "2024-01-01 10:00:00", "user_id": "a"}] * 2)   # old duplicate
    first = make_raw(spark, [{"event_time": "2024-01-05 10:00:00", "user_id": "b"}])
    refresh.refresh_events(spark, first, wh)
    both = old.unionByName(first)
    with pytest.raises(DataQualityError):
        refresh.refresh_all(spark, both, wh)                       # whole source: duplicate found
    r = refresh.refresh_all(spark, both, wh, run_quality=True, precheck_scope="window",
                            event_types=("like",))
    assert ("source_duplicates", "error", 0) in r.checks


def test_half_written_table_is_not_existing(spark):
    import os
    path = scratch_path(spark, "half")
    os.makedirs(os.path.join(path, "_temporary", "0"))
    assert not sinks.exists(spark, path)
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "id string, d date")
    sinks.replace(df, path, "d")
    assert sinks.exists(spark, path)


def test_upsert_keep_latest_resolves_duplicates(spark):
    path = scratch_path(spark, "keep-latest")
    D, T = dt.date, dt.datetime
    base = spark.createDataFrame([("a", D(2024, 1, 1), 1, T(2024, 1, 1))], "id string, d date, v int, loaded_at timestamp_ntz")
    sinks.replace(base, path, "d")
    inc = spark.createDataFrame([("a", D(2024, 1, 1), 2, T(2024, 1, 2)), ("a", D(2024, 1, 1), 3, T(2024, 1, 3))],
                                "id string, d date, v int, loaded_at timestamp_ntz")
    sinks.upsert(spark, path, inc, "id", "d", on_duplicate="keep_latest")
    assert [(r.id, r.v) for r in spark.read.parquet(path).collect()] == [("a", 3)]
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()   # nothing left cached

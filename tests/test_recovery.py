"""A refresh that dies at any stage boundary is made good by the next run."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.params import RunParams
from tidemark.plans import refresh, sinks
from tidemark.session import scratch_path
from tidemark.sources.adapters import raw_events

SF = "/root/testdata/sf0.001"
P = RunParams(late_arrival_lookback_days=3, period_lookback_days=62)
ALL_TABLES = [*refresh.TABLES, refresh.DAY_BASE]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def snapshot(spark, wh):
    return {t: rows_of(refresh.read_table(spark, wh, t)) for t in ALL_TABLES}


@pytest.fixture(scope="module")
def deliveries(spark):
    raw = raw_events(spark, SF)
    days = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)]
    return [raw.filter(F.col("event_time") < F.lit(d)) for d in days] + [raw]


@pytest.fixture(scope="module")
def rebuilt(spark, deliveries):
    wh = scratch_path(spark, "recovery-full")
    refresh.refresh_all(spark, deliveries[-1], wh, P, run_quality=False)
    return snapshot(spark, wh)


@pytest.mark.parametrize("table, when", [
    ("stg_events", "after"), ("dim_users", "after"), ("fct_events", "before"), ("fct_events", "after"), ("user_day_segments", "after"),
    ("fct_growth_accounting", "after"), ("fct_cohort_retention_triangle", "before"), ("user_period_activity", "after"),
    ("fct_engagement_depth", "before")])
def test_refresh_recovers(spark, deliveries, rebuilt, table, when):
    wh = scratch_path(spark, f"recovery-{table}-{when}")
    refresh.refresh_all(spark, deliveries[0], wh, P, run_quality=False)

    def dying(*step):
        if step == (table, when):
            raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        refresh.refresh_all(spark, deliveries[1], wh, P, run_quality=False, on_step=dying)
    refresh.refresh_all(spark, deliveries[1], wh, P, run_quality=False)
    refresh.refresh_all(spark, deliveries[2], wh, P, run_quality=False)
    got = snapshot(spark, wh)
    for t in ALL_TABLES:
        assert got[t] == rebuilt[t], t
    assert not sinks.pending(spark, wh, "base") and not sinks.pending(spark, wh, "periods")


def test_base_check_sees_lost_days(spark, deliveries):
    wh = scratch_path(spark, "recovery-check")
    refresh.refresh_all(spark, deliveries[2], wh, P, run_quality=False)
    base, fct = refresh.read_table(spark, wh, refresh.DAY_BASE), refresh.read_table(spark, wh, "fct_events")
    assert dq.base_matches_fact(base, fct).count() == 0
    day = base.agg(F.max("activity_date")).first()[0]
    assert dq.base_matches_fact(base.filter(F.col("activity_date") != F.lit(day)), fct).count() == 1


def test_few_files_for_each_partition(spark, deliveries):
    """Full and incremental builds write a few files per partition, whatever the number of input tasks."""
    wh = scratch_path(spark, "recovery-files")
    refresh.refresh_all(spark, deliveries[1].repartition(16), wh, P, run_quality=False)
    refresh.refresh_all(spark, deliveries[2].repartition(16), wh, P, run_quality=False)
    for t in ALL_TABLES:
        for folder, _, files in os.walk(os.path.join(wh, t)):
            assert sum(f.endswith(".parquet") for f in files) <= 2, folder

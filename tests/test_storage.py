"""Stored layout: buckets of the dimension, swapped tables, freshness, reconciliation, optional parts."""
import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import make_raw
from tidemark import Marts
from tidemark.operators.reporting import mart_for_bi
from tidemark.params import RunParams
from tidemark.plans import freshness, refresh, sinks
from tidemark.session import checkpoint_root, scratch_path
from tidemark.sources.loads import load_bounds, load_interval

T = dt.datetime


def files_of(path):
    return {os.path.join(os.path.relpath(d, path), f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_only_buckets_with_changed_users_are_rewritten(spark):
    wh, p = scratch_path(spark, "buckets"), RunParams(dim_buckets=8, late_arrival_lookback_days=3)
    users = [f"u{i}" for i in range(30)]
    rows = [{"event_time": "2024-01-10 10:00:00", "user_id": u, "platform": "ios"} for u in users]
    refresh.refresh_events(spark, make_raw(spark, rows), wh, p)
    dim = os.path.join(wh, "dim_users")
    before = files_of(dim)
    assert sinks.stored_buckets(spark, dim) == 8 and len({f.split("/")[0] for f in before}) == 8
    # the same events once more, and one user with a new one; the parameter of a later run doesn't matter
    more = rows + [{"event_time": "2024-01-10 12:00:00", "user_id": "u7", "platform": "web"}]
    refresh.refresh_events(spark, make_raw(spark, more), wh, RunParams(dim_buckets=99, late_arrival_lookback_days=3))
    after = files_of(dim)
    gone = {f.split("/")[0] for f in before - after}
    bucket = spark.read.parquet(dim).filter("user_id = 'u7'").first()
    assert gone == {f"user_bucket={bucket.user_bucket}"} and bucket.latest_platform == "web"
    assert refresh.read_table(spark, wh, "dim_users").count() == 30
    refresh.refresh_events(spark, make_raw(spark, more), wh, p)
    assert files_of(dim) == after       # nothing changed, nothing written


def test_the_stored_side_of_the_merge_is_not_exchanged(spark):
    """Joining bucketed rows with new profiles shuffles the profiles alone."""
    from tidemark.operators.core import DIM_COLUMNS, user_profile
    wh = scratch_path(spark, "bucket-plan")
    raw = make_raw(spark, [{"event_time": "2024-01-10 10:00:00", "user_id": f"u{i}", "platform": "ios"} for i in range(50)])
    refresh.refresh_events(spark, raw, wh, RunParams(dim_buckets=6))
    path = refresh.table_path(wh, "dim_users")
    schema = spark.read.parquet(path).select(*DIM_COLUMNS, "user_bucket").schema
    profiles = user_profile(Marts(raw).stg_events).select("*", sinks.bucket_of("user_id", 6).alias("user_bucket"))
    with sinks.bucketed_table(spark, path, schema, "user_bucket", "user_id", 6) as name:
        plan = refresh.merge_dim(spark.table(name), profiles, [1, 4], 6)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
        indent = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
        scan, branch, depth = lines[at], [], indent(lines[at])
        for x in reversed(lines[:at]):           # the operators above the scan, up to the join
            if indent(x) < depth:
                depth = indent(x)
                if "Join" in x:
                    break
                branch.append(x)
        assert "Join" in x and not any("Exchange" in y for y in branch), plan
        assert "user_bucket" in scan and "IN (1,4)" in scan and "SelectedBucketsCount: 6 out of 6" in scan
    assert not spark.catalog.tableExists(name) and spark.read.parquet(path).count() == 50


def test_an_older_layout_is_brought_into_buckets(spark):
    wh = scratch_path(spark, "old-layout")
    rows = [{"event_time": "2024-01-10 10:00:00", "user_id": f"u{i}", "platform": "ios"} for i in range(9)]
    refresh.refresh_events(spark, make_raw(spark, rows), wh)
    path = refresh.table_path(wh, "dim_users")
    old = refresh.read_table(spark, wh, "dim_users").withColumn("user_bucket", F.lit(3)).checkpoint()
    sinks.drop_path(spark, path)
    sinks.replace(old, path, "user_bucket")
    refresh.refresh_events(spark, make_raw(spark, rows + [{"event_time": "2024-01-11", "user_id": "new"}]), wh, RunParams(dim_buckets=5))
    assert sinks.stored_buckets(spark, path) == 5
    got = spark.read.parquet(path)
    assert got.count() == 10 and got.filter(F.col("user_bucket") != sinks.bucket_of("user_id", 5)).count() == 0


def test_a_killed_swap_is_made_good(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{path}.replaced-abc")              # killed between the renames
    sinks.heal_swap(spark, path)
    assert spark.read.parquet(path).count() == 3
    spark.range(9).write.parquet(f"{path}.replaced-def")              # killed before the old one was removed
    spark.range(5).write.parquet(f"{path}.loading-1")
    sinks.swap_in(spark, f"{path}.loading-1", path)
    assert spark.read.parquet(path).count() == 5
    assert [n for n in os.listdir(tmp_path) if not n.startswith(".")] == ["t"]


def test_merge_by_key_bytes_equals_merge_by_text(spark, tmp_path):
    old = spark.range(40).selectExpr("md5(CAST(id AS STRING)) AS k", "id % 4 AS part", "'old' AS v")
    new = spark.range(30, 50).selectExpr("md5(CAST(id AS STRING)) AS k", "id % 4 AS part", "'new' AS v")
    got = []
    for hex_key in (False, True):
        path = str(tmp_path / str(hex_key))
        sinks.replace(old, path, "part")
        sinks.upsert(spark, path, new, "k", "part", hex_key=hex_key)
        got.append(sorted(tuple(r) for r in spark.read.parquet(path).select("k", "part", "v").collect()))
    assert got[0] == got[1] and len(got[0]) == 50 and sum(r[2] == "new" for r in got[0]) == 20
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.upsert(spark, path, new.unionByName(new.limit(1)), "k", "part", hex_key=True)


def test_freshness_from_what_loads_noted(spark, tmp_path):
    table = str(tmp_path / "t")
    assert freshness.stale_source(spark, table, T(2024, 1, 1), dt.timedelta(1)).first().problem == "nothing has been loaded"
    source = make_raw(spark, [{"event_time": f"2024-01-{d:02d} 10:00:00", "user_id": "a", "loaded_at": T(2024, 1, d, 12)} for d in (2, 5, 9)])
    load_interval(spark, source, table, T(2024, 1, 6))
    load_interval(spark, source, table, T(2024, 1, 20))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fresh", "fresh")
    bounds = load_bounds(spark, table)
    stale = freshness.stale_source(spark, table, T(2024, 1, 10, 13), dt.timedelta(days=1), dt.timedelta(days=2))
    late = freshness.beyond_cutoff(spark, f"{table}/run=00000002-001", "event_date", T(2024, 1, 8))
    assert not tracker.getJobIdsForGroup("fresh")                     # no file of the table was read
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert bounds == {"rows": 3, "min_event_time": T(2024, 1, 2, 10), "max_event_time": T(2024, 1, 9, 10), "max_loaded_at": T(2024, 1, 9, 12)}
    assert [r.problem for r in stale.collect()] == ["last loaded more than 1 day, 0:00:00 ago"]
    assert freshness.stale_source(spark, table, T(2024, 1, 10), dt.timedelta(days=1)).count() == 0
    assert [str(r.partition_day) for r in late.collect()] == ["2024-01-09"]


def test_only_the_cutoffs_own_day_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"2024-01-{d:02d} {h}:00:00",) for d in (1, 2, 3) for h in ("09", "15")]
    df = spark.createDataFrame(rows, "s string").selectExpr("CAST(s AS TIMESTAMP_NTZ) AS t", "CAST(s AS DATE) AS day")
    df.write.partitionBy("day").parquet(path)
    found = freshness.beyond_cutoff(spark, path, "day", T(2024, 1, 2, 12), "t")
    assert sorted((str(r.partition_day), r.rows) for r in found.collect()) == [("2024-01-02", 1), ("2024-01-03", None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(t," in plan
    assert freshness.beyond_cutoff(spark, path, "day", T(2024, 1, 3, 15), "t").count() == 0


def test_reconciled_runs(spark):
    """Stored bitmaps follow the days that runs touch, also runs that didn't reconcile."""
    wh = scratch_path(spark, "reconciled")
    checkpoint_root(spark)
    rows = [{"event_time": f"2024-01-{d:02d} 0{k}:00:00", "user_id": u, "platform": "ios", "country": "SG", "event_type": "like"}
            for d in range(1, 16) for k, u in enumerate("abcd") if (d + k) % 3]
    source = make_raw(spark, rows)
    for day, reconcile in ((6, True), (10, False), (20, True)):
        report = refresh.refresh_all(spark, source.filter(F.col("event_time") < F.lit(T(2024, 1, day))), wh, reconcile=reconcile)
    assert {("cross_grain_users", "warn", 0), ("cross_grain_totals", "warn", 0)} <= set(report.checks)
    assert ("growth_identity", "error", 0) in report.checks          # from the ledger of checked partitions
    g = refresh.table_path(wh, "fct_growth_accounting")
    bad = spark.read.parquet(g).filter("period_start = DATE '2024-01-08'").withColumn("active_users", F.col("active_users") + 1).checkpoint()
    sinks.overwrite_partitions(bad, g, "period_start")
    users, totals = refresh.cross_grain_checks(spark, wh)
    assert users.failing_rows.count() == bad.count() and totals.failing_rows.count() == 0


def test_the_bi_mart_is_ordered(raw):
    m = Marts(raw([{"event_time": f"2024-0{k}-{d:02d}", "user_id": u, "country": c} for k in (1, 2) for d in (1, 9, 17) for u, c in (("a", "SG"), ("b", "MY"))]))
    got = [(r.period_grain, r.period_start) for r in mart_for_bi(m.growth_accounting).collect()]
    assert got == sorted(got) and len(got) > 20


def test_other_queries_survive_a_missing_tokenizer_library():
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'growth_accounting' in q and 'pipeline' not in q; print(len(q))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr

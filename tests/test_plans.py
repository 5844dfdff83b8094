"""Physical-plan properties the design relies on, and a hot-key fixture.

* the scan reads only the columns a query needs and receives its filters;
* events are pre-aggregated before the first shuffle (a hot user is
  combined map-side);
* the period aggregate and the activity window reuse one user_id
  partitioning (no exchange between them);
* a user holding ~40% of all events gives the same answers as the oracle.
"""
import os
import re

import duckdb
import pyarrow.parquet as pq
import pyarrow.compute as pc
import datetime as dt

import pytest

import sys
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as se
from catalog.oracle import ORACLE_SQL
from tidemark.params import RunParams
from tidemark.plans.marts import Marts
from tidemark.sources.adapters import raw_events

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning_and_pushdown(spark):
    m = Marts(raw_events(spark, SF), RunParams(execution_date="2024-01-15 12:00:00"))
    p = plan_text(m.growth_accounting)
    events_scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "events" in ln.lower() and "ts" in ln]
    assert events_scan, p
    schema = re.search(r"ReadSchema: struct<([^>]*)>", events_scan[0]).group(1)
    assert "event_type" not in schema and "value" not in schema   # not needed for growth
    assert "LessThanOrEqual(ts" in events_scan[0]                   # cutoff reaches the scan


def test_partial_aggregation_and_shared_partitioning(spark):
    m = Marts(raw_events(spark, SF))
    p = plan_text(m.growth_accounting)
    lines = p.splitlines()
    # exchanges, top-down: final growth agg, repartition(user_id), daily agg, adapter join sides
    exch = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    repart = [i for i in exch if "REPARTITION_BY_COL" in lines[i]]
    assert len(repart) == 1
    between = "\n".join(lines[:repart[0]])
    # window and period aggregate sit above the user_id repartition with no exchange in between
    win = max(i for i, ln in enumerate(lines) if "Window [" in ln)
    assert not any(win < i < repart[0] for i in exch)
    assert "Window" in between
    # the daily aggregate below it is split into partial + final around its exchange
    below = lines[repart[0]:]
    assert any("HashAggregate" in ln for ln in below[1:3])
    daily_ex = next(i for i, ln in enumerate(below) if "Exchange hashpartitioning" in ln and "ENSURE" in ln)
    assert "HashAggregate" in below[daily_ex + 1]


def test_activity_has_one_user_shuffle_after_daily_base(spark):
    m = Marts(raw_events(spark, SF))
    lines = plan_text(m.activity).splitlines()
    win = next(i for i, ln in enumerate(lines) if "Window [" in ln)
    first_exchange = next(i for i, ln in enumerate(lines) if "Exchange" in ln)
    assert first_exchange > win and "REPARTITION_BY_COL" in lines[first_exchange]
    assert "user_id" in lines[first_exchange]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    """sf0.01 tables where one customer owns every click and view (~40% of events)."""
    d = tmp_path_factory.mktemp("hot")
    ev = pq.read_table("/root/testdata/sf0.01/events.parquet")
    hot = pc.is_in(ev["event_type"], value_set=__import__("pyarrow").array(["click", "view"]))
    uid = pc.if_else(hot, 1, ev["user_id"])
    pq.write_table(ev.set_column(ev.schema.get_field_index("user_id"), "user_id", uid), d / "events.parquet")
    for t in ("customer", "nation", "orders"):
        pq.write_table(pq.read_table(f"/root/testdata/sf0.01/{t}.parquet"), d / f"{t}.parquet")
    return str(d)


@pytest.mark.parametrize("name", ["growth_accounting", "cohort_retention_triangle", "engagement_depth",
                                  "dim_users", "fct_events", "dq_seeded_faults"])
def test_hot_user_matches_oracle(spark, hot_dir, name):
    from compare import digest
    con = duckdb.connect()
    for t in ("events", "customer", "nation", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(hot_dir, t + '.parquet')}')")
    df = se.queries()[name](spark, hot_dir)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE_SQL[name])
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_incremental_window_prunes_date_partitions(spark):
    from tidemark.operators.core import fct_events
    from tidemark.plans import refresh
    from tidemark.session import scratch_path
    import datetime as dt
    wh = scratch_path(spark, "prune")
    refresh.refresh_events(spark, raw_events(spark, SF), wh)
    stg = refresh.read_table(spark, wh, "stg_events")
    df = fct_events(stg, RunParams(), after=dt.datetime(2024, 1, 25, 6))
    p = plan_text(df)
    scan = next(ln for ln in p.splitlines() if "FileScan parquet" in ln and "stg_events" in ln)
    assert "PartitionFilters: [isnotnull(event_date_utc" in scan and "2024-01-25" in scan


def test_fct_key_needs_no_event_shuffle(spark):
    from tidemark.operators.core import FCT_COLUMNS, fct_events, missing_users
    from tidemark.plans.refresh import materialize
    m = Marts(raw_events(spark, SF))
    dim = m.dim_users.filter("latest_platform IS NULL OR latest_platform <> 'web'")   # some users missing
    joined = m.stg_events.join(dim.select("user_id", "user_sk"), "user_id", "left").select(*FCT_COLUMNS)
    missing, _ = materialize(missing_users(m.stg_events, dim), spark, "missing")
    keyed = fct_events(m.stg_events, missing=missing)
    rows = lambda df: sorted(map(tuple, df.select(*FCT_COLUMNS).collect()), key=repr)
    assert rows(keyed) == rows(joined)
    assert any(r.user_sk is None for r in keyed.collect())
    assert "BroadcastHashJoin" in plan_text(keyed)
    # with a dimension built from the same rows there is nothing to look up
    lazy = plan_text(fct_events(m.stg_events))
    assert lazy.count("Join") == plan_text(m.stg_events).count("Join")


def test_dim_users_sorts_no_events(spark):
    """The event-level aggregate hashes; only a user's attribute combinations are sorted."""
    p = plan_text(Marts(raw_events(spark, SF)).dim_users)
    below = p[p.index("HashAggregate(keys=[user_id"):]
    assert "SortAggregate" not in below


def test_latest_attribute_ties_break_on_event_id(spark):
    from tidemark.operators.core import user_profile
    rows = [("u", dt.datetime(2024, 1, 1), f"{i:x}" * 32, None, f"p{i}", None, None) for i in (3, 12, 7)]
    rows += [("u", dt.datetime(2024, 1, 2), "0" * 32, "g", None, None, None)]
    df = spark.createDataFrame(rows, "user_id string, event_time_utc timestamp_ntz, event_id string, gender string, "
                                     "platform string, country string, utm_source string")
    got = user_profile(df).first()
    assert (got.latest_platform, got.latest_gender, got.latest_country) == ("p12", "g", None)
    assert (got.first_event_time_utc, got.latest_event_time_utc) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))


def test_repeated_values_is_one_scan_and_one_exchange(spark):
    from tidemark.operators.quality import unique
    stg = spark.range(1000).selectExpr("md5(CAST(id % 900 AS string)) AS event_id")
    df = unique(stg, "event_id", hex_key=True)
    p = plan_text(df)
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p
    assert df.count() == 100 and {len(r.event_id) for r in df.collect()} == {32}


@pytest.mark.parametrize("attr", ["growth_accounting", "cohort_retention_triangle", "engagement_depth"])
def test_marts_have_no_joins_beyond_the_source_lookup(spark, attr):
    """Above the daily base the marts are aggregates and windows only: the
    dimension join is pruned and no mart-level join remains."""
    m = Marts(raw_events(spark, SF))
    p = plan_text(getattr(m, attr))
    above_base = p.split("REPARTITION_BY_COL")[0]
    assert "Join" not in above_base
    assert p.count("Exchange hashpartitioning") <= 5   # day base, user repartition, mart agg (+ triangle window, adapter)

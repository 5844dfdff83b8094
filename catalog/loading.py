"""Queries of exactly-once loads: by time interval and by file."""
from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import ts_ntz
from tidemark.operators.staging import stg_events
from tidemark.plans.ledger import ClaimRefused
from tidemark.session import join_path, scratch_path
from tidemark.sources.adapters import raw_events
from tidemark.sources.csv_ingest import write_events_csv
from tidemark.sources.loads import load_files, load_interval, read_loaded

from .queries import LOADED_AT, query

INTERVAL_ENDS = (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 1, 22), dt.datetime(2024, 2, 10))


class Lost(RuntimeError):
    """A run that dies."""


def dies_after(step: str | None):
    def on_step(now: str) -> None:
        if now == step:
            raise Lost(step)
    return on_step


def _labelled(loaded: DataFrame, name: str, parts: list) -> DataFrame:
    """Staged rows of each (label, condition), with the label."""
    return reduce(DataFrame.unionByName, [stg_events(loaded.filter(c)).withColumn(name, F.lit(label)) for label, c in parts])


@query("interval_ingest")
def interval_ingest(spark, sf_dir):
    """Events loaded in four intervals, of which the first three runs die: after
    the claim, after the write, after the commit. The next run of each goes on."""
    table, raw = scratch_path(spark, "interval-loads"), raw_events(spark, sf_dir)
    for end, step in zip(INTERVAL_ENDS, ("claim", "write", "commit", None)):
        try:
            load_interval(spark, raw, table, end, on_step=dies_after(step))
        except Lost:
            try:
                load_interval(spark, raw, table, end, take_over=True)
            except ClaimRefused:
                pass   # it had been committed
    loaded = read_loaded(spark, table)
    return _labelled(loaded, "interval_no", [(k, F.col("run").startswith(f"{k:08d}-")) for k in range(1, len(INTERVAL_ENDS) + 1)])


DELIVERY_DAYS = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))


@query("file_loads")
def file_loads(spark, sf_dir):
    """Three deliveries of CSV files in two layouts; the first is in the folder
    again when the second comes, and the second once more, as a copy, with the
    third. Each row with the delivery that its file came in."""
    source, table = scratch_path(spark, "deliveries"), scratch_path(spark, "file-loads")
    raw = raw_events(spark, sf_dir).drop("loaded_at")
    a, b = map(ts_ntz, DELIVERY_DAYS)
    t = F.col("event_time")
    parts = [raw.filter(t < a), raw.filter((t >= a) & (t < b)).select(F.lit('x, "y"').alias("note"), *reversed(raw.columns)), raw.filter(t >= b)]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for i, part in enumerate(parts, 1):
        write_events_csv(part, join_path(source, f"d{i}"))
        if i == 3:
            path = jvm.org.apache.hadoop.fs.Path
            first, again = path(join_path(source, "d2")), path(join_path(source, "again"))
            fs = first.getFileSystem(conf)
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, first, fs, again, False, conf)
        load_files(spark, join_path(source, "*"), table, LOADED_AT)
    loaded = read_loaded(spark, table)
    return _labelled(loaded, "delivery", [(f"d{i}", F.col("source_file").contains(f"/d{i}/")) for i in range(1, 4)])


@query("dq_freshness")
def dq_freshness(spark, sf_dir):
    """Staleness of events loaded in two intervals, at two moments, and what the
    stored fact of a cutoff-bounded run holds beyond that cutoff and an earlier one."""
    from tidemark.operators import quality as dq
    from tidemark.params import RunParams
    from tidemark.plans import freshness, sinks
    from tidemark.plans.marts import Marts
    from .queries import CUTOFF, _summary
    table, fct, raw = scratch_path(spark, "fresh-loads"), scratch_path(spark, "fresh-fct"), raw_events(spark, sf_dir)
    for end in INTERVAL_ENDS[1:3]:
        load_interval(spark, raw, table, end)
    cutoff, day = dt.datetime.fromisoformat(CUTOFF), dt.timedelta(days=1)
    sinks.replace(Marts(raw, RunParams(execution_date=CUTOFF)).fct_events, fct, "event_date_utc")
    end = INTERVAL_ENDS[2]
    checks = [dq.Check(f"stale_{name}", freshness.stale_source(spark, table, at, day, 2 * day))
              for name, at in (("at_once", end), ("later", end + 1.5 * day), ("much_later", end + 9 * day))]
    checks += [dq.Check(f"beyond_{name}", freshness.beyond_cutoff(spark, fct, "event_date_utc", at, "event_time_utc")
                        .selectExpr("coalesce(rows, 1) AS n_records"), weighted=True)
               for name, at in (("cutoff", cutoff), ("earlier", cutoff - dt.timedelta(days=3, hours=2)))]
    return _summary(checks)


@query("dq_changed_partitions")
def dq_changed_partitions(spark, sf_dir):
    """Post-check totals after two runs and a fault seeded in an old partition:
    only what the second run and the fault rewrote is checked the second time."""
    from tidemark.plans import check_ledger, refresh, sinks
    from tidemark.session import checkpoint_root
    from .checks import SEEDED_DAY, SEEDED_TYPES
    from .queries import _batches
    wh = scratch_path(spark, "checked")
    b1, raw_all = _batches(spark, sf_dir)
    refresh.refresh_all(spark, b1, wh, run_quality=False)
    check_ledger.check_changed(spark, wh, SEEDED_TYPES)
    refresh.refresh_all(spark, raw_all, wh, run_quality=False)
    path = refresh.table_path(wh, "fct_growth_accounting")
    checkpoint_root(spark)
    day = spark.read.parquet(path).filter(F.col("period_start") == F.lit(SEEDED_DAY))
    sinks.overwrite_partitions(day.withColumn("new_users", F.col("new_users") + 1).checkpoint(), path, "period_start")
    report = check_ledger.check_changed(spark, wh, SEEDED_TYPES)
    return spark.createDataFrame([(name, n) for name, _, n in report.totals], "check string, failures long")

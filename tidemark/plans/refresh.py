"""Incremental and full refresh of every model, table by table.

Layout under ``warehouse`` (Parquet):

  stg_events/                partitioned by event_date_utc   (upsert on event_id)
  dim_users/                 partitioned by user_bucket      (upsert on user_id)
  fct_events/                partitioned by event_date_utc   (upsert on event_id)
  user_day_segments/         partitioned by activity_date    (touched days recomputed)
  user_state/as_of=<day>/    one row per user and segment     (advanced, see below)
  user_period_activity/      partitioned by period_start     (partition overwrite)
  fct_growth_accounting/     partitioned by period_start     (partition overwrite)
  fct_cohort_retention_triangle/  partitioned by cohort_start (partition overwrite)
  fct_engagement_depth/      partitioned by period_start     (partition overwrite)

Event models reprocess events strictly newer than ``watermark - late
arrival lookback``; period models rewrite periods strictly newer than
``max(target period) - period lookback``, with flags computed on the full
history first. Those flags need every user's history, but not every event:
the period marts read the daily user-segment base (one row per user, day and
segment), which an incremental run maintains by recomputing only the days its
event window touched - the event fact is never rescanned. The base has no
watermark of its own: a run records the days it owes the base and the period
marts before it commits the fact, and clears the record after their commit,
so a run that dies in between is made good by the next one.

Of the past an incremental run needs each user's first and last day per segment
only. These are stored as of a day that lies before every period the run may
rewrite, so it reads the days since then and the state, not the history. The
state is advanced, from the days in between, once it lags ``STATE_STRIDE`` behind;
a version is a folder of its own that counts once it is complete, and versions
as of a day on or after a changed one are dropped. The classified activity is
materialised once per run (a written table in the shared checkpoint folder) and
feeds all period marts.

``on_step(name, when)`` is called before and after each table's commit; what it
raises stops the run there.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import activity as act
from ..operators import quality as dq
from ..operators.core import (DIM_COLUMNS, USER_ATTRIBUTES, dim_users, fct_events, merge_dim_rows,
                              missing_users, user_profile)
from ..operators.distinct_state import distinct_users
from ..operators.engagement import engagement_depth
from ..operators.growth import growth_accounting
from ..operators.retention import cohort_retention_triangle, cohort_retention_triangle_since
from ..operators.staging import stg_events, time_window
from ..params import RunParams
from ..session import checkpoint_root, ensure_utc, join_path, scratch_path
from . import distinct, sinks

TABLES = ("stg_events", "dim_users", "fct_events", "user_period_activity", "fct_growth_accounting",
          "fct_cohort_retention_triangle", "fct_engagement_depth")
DAY_BASE = "user_day_segments"
USER_STATE = "user_state"
#: How far the stored user state may lag before it is advanced.
STATE_STRIDE = dt.timedelta(days=31)
# Physical layout: (partition column, cluster columns) per table.
LAYOUT = {
    "stg_events": ("event_date_utc", ("user_id", "event_type")),
    "dim_users": ("user_bucket", ("user_id",)),
    "fct_events": ("event_date_utc", ("user_id", "event_type")),
    "user_day_segments": ("activity_date", ("user_id",)),
    "user_period_activity": ("period_start", ("country", "platform", "utm_source", "user_id")),
    "fct_growth_accounting": ("period_start", ("country", "platform", "utm_source", "period_grain")),
    "fct_cohort_retention_triangle": ("cohort_start", ("country", "platform", "utm_source", "cohort_grain")),
    "fct_engagement_depth": ("period_start", ("country", "platform", "utm_source", "period_grain")),
}


@dataclass
class RefreshReport:
    windows: dict
    checks: list


def table_path(warehouse: str, name: str) -> str:
    return join_path(warehouse, name)


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(warehouse, name))
    return df.drop("user_bucket") if name == "dim_users" else df


def event_lower_bound(spark, path, ts_col, part, params) -> dt.datetime | None:
    """Exclusive lower bound on event time for an incremental run of the
    table at ``path``: its watermark minus the late-arrival lookback (None
    for a full refresh or a missing table)."""
    if params.full_refresh:
        return None
    wm = sinks.max_event_time(spark, path, ts_col, part)
    return None if wm is None else wm - dt.timedelta(days=params.late_arrival_lookback_days)


def period_lower_bound(spark, path, part, params) -> dt.date | None:
    """Exclusive lower bound on period start: the newest stored period minus
    the period lookback (None for a full refresh or a missing table)."""
    if params.full_refresh or not sinks.exists(spark, path):
        return None
    newest = sinks.max_partition_date(spark, path, part)
    return None if newest is None else newest - dt.timedelta(days=params.period_lookback_days)


def no_step(name: str, when: str) -> None:
    """The default for ``on_step``."""


def refresh_events(spark: SparkSession, raw: DataFrame, warehouse: str,
                   params: RunParams = RunParams(), on_duplicate: str = "fail",
                   on_step: Callable[[str, str], None] = no_step) -> dict:
    """stg_events -> dim_users -> fct_events. Returns the windows used."""
    ensure_utc(spark)
    windows = {}
    p_stg = table_path(warehouse, "stg_events")
    after = event_lower_bound(spark, p_stg, "event_time_utc", "event_date_utc", params)
    windows["stg_events"] = after
    stg_new = stg_events(raw, params, after)
    part, clus = LAYOUT["stg_events"]
    on_step("stg_events", "before")
    if after is None:
        sinks.replace(stg_new, p_stg, part, clus)
    else:
        sinks.upsert(spark, p_stg, stg_new, "event_id", part, on_duplicate, clus, hex_key=True)
    on_step("stg_events", "after")
    stg = read_table(spark, warehouse, "stg_events")

    on_step("dim_users", "before")
    windows["dim_users"] = refresh_dim(spark, stg, warehouse, params)
    on_step("dim_users", "after")
    dim = read_table(spark, warehouse, "dim_users").select(*DIM_COLUMNS)

    p_fct = table_path(warehouse, "fct_events")
    f_after = event_lower_bound(spark, p_fct, "event_time_utc", "event_date_utc", params)
    windows["fct_events"] = f_after
    missing, scratch = materialize(missing_users(stg, dim, params, f_after), spark, "missing-users")
    fct_new = fct_events(stg, params, f_after, missing)
    part, clus = LAYOUT["fct_events"]
    # Once the fact is committed its watermark hides this window from a retry,
    # so what the later stages owe is recorded before.
    base_after = sinks.mark_pending(spark, warehouse, "base", f_after)
    windows["changed_since"] = sinks.mark_pending(spark, warehouse, "periods", f_after)
    if sinks.exists(spark, table_path(warehouse, distinct.DAY_DISTINCT)):
        sinks.mark_pending(spark, warehouse, "distinct", f_after)
    on_step("fct_events", "before")
    if f_after is None:
        sinks.replace(fct_new, p_fct, part, clus)
    else:
        sinks.upsert(spark, p_fct, fct_new, "event_id", part, on_duplicate, clus, hex_key=True)
    on_step("fct_events", "after")
    sinks.drop_path(spark, scratch)
    on_step(DAY_BASE, "before")
    refresh_day_base(spark, warehouse, base_after)
    on_step(DAY_BASE, "after")
    sinks.clear_pending(spark, warehouse, "base")
    return windows


def refresh_dim(spark: SparkSession, stg: DataFrame, warehouse: str, params: RunParams) -> dt.datetime | None:
    """Build or maintain the user dimension; returns the lower bound of the
    events that were read.

    A full build stores ``params.dim_buckets`` buckets by the hash of the user
    (their number is kept with the table). A merge reads the buckets of the users
    it has events of, without an exchange of the stored rows, and rewrites those
    buckets in which a row really changed: users whose events were only
    delivered again cost no write."""
    path, (part, _) = table_path(warehouse, "dim_users"), LAYOUT["dim_users"]
    if params.full_refresh or not sinks.exists(spark, path):
        sinks.replace_bucketed(dim_users(stg, params), path, part, "user_id", params.dim_buckets)
        return None
    n = sinks.stored_buckets(spark, path)
    if n is None:   # an older layout: bring the stored rows into this one
        n = params.dim_buckets
        sinks.replace_bucketed(read_table(spark, warehouse, "dim_users").select(*DIM_COLUMNS), path, part, "user_id", n)
    schema = spark.read.parquet(path).select(*DIM_COLUMNS, part).schema
    with sinks.bucketed_table(spark, path, schema, part, "user_id", n) as name:
        existing = spark.table(name)
        wm = existing.agg(F.max("latest_event_time_utc")).first()[0]
        after = None if wm is None else wm - dt.timedelta(days=params.late_arrival_lookback_days)
        incoming = user_profile(
            time_window(stg, "event_time_utc", after, params.cutoff_ts(), date_col="event_date_utc")
            .select("user_id", "event_time_utc", "event_id", *USER_ATTRIBUTES)).select("*", sinks.bucket_of("user_id", n).alias(part))
        incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)   # used for the bucket list and the merge
        try:
            touched = [r[0] for r in incoming.select(part).distinct().collect()]  # <= n
            if touched:
                checkpoint_root(spark)
                # the rewrite replaces the buckets the merge reads: cut lineage first
                merged = merge_dim(existing, incoming, touched, n).checkpoint(eager=True)
                changed = [r[0] for r in merged.filter("row_changed").select(part).distinct().collect()]
                if changed:
                    sinks.overwrite_buckets(merged.filter(F.col(part).isin(changed)).select(*DIM_COLUMNS, part), name, "user_id", n)
        finally:
            incoming.unpersist()
    return after


def merge_dim(existing: DataFrame, incoming: DataFrame, touched: list[int], buckets: int) -> DataFrame:
    """The touched buckets of the stored dimension merged with incoming profiles, and whether each row changed."""
    part = LAYOUT["dim_users"][0]
    merged = merge_dim_rows(existing.filter(F.col(part).isin(touched)), incoming.drop(part), flag="row_changed")
    return merged.select("*", sinks.bucket_of("user_id", buckets).alias(part))


def refresh_day_base(spark: SparkSession, warehouse: str, after: dt.datetime | None) -> None:
    """Maintain ``user_day_segments`` from the stored fact.

    A day's rows depend only on that day's events, so after an incremental
    event run only the days on or after the window start are recomputed
    (a partition-pruned read of the fact) and overwritten.
    """
    fct = read_table(spark, warehouse, "fct_events")
    path = table_path(warehouse, DAY_BASE)
    part, clus = LAYOUT[DAY_BASE]
    if after is None or not sinks.exists(spark, path):
        sinks.replace(act.user_day_segments(fct), path, part, clus)
        return
    recent = fct.filter(F.col("event_date_utc") >= F.lit(after.date()))
    sinks.overwrite_partitions(act.user_day_segments(recent), path, part, cluster_by=clus)


def ignored_late_events(spark: SparkSession, raw: DataFrame, warehouse: str,
                        params: RunParams = RunParams()) -> DataFrame:
    """Source events (staged, within the cutoff) that the event fact does not
    hold: late arrivals older than the lookback window at the time of their
    run. They stay out until a full refresh."""
    stored = read_table(spark, warehouse, "fct_events").select("event_id")
    return stg_events(raw, params).join(stored, "event_id", "left_anti")


def materialize(df: DataFrame, spark: SparkSession, name: str) -> tuple[DataFrame, str]:
    """Write to a fresh folder under the shared checkpoint dir and read back:
    cuts lineage and survives executor loss (unlike cached blocks)."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path), path


def state_path(warehouse: str, as_of: dt.date) -> str:
    return join_path(table_path(warehouse, USER_STATE), f"as_of={as_of.isoformat()}")


def state_versions(spark: SparkSession, warehouse: str) -> list[dt.date]:
    """The days of which there is a complete state, in order."""
    days = [dt.date.fromisoformat(v) for v in sinks.partition_values(spark, table_path(warehouse, USER_STATE), "as_of")]
    return sorted(d for d in days if sinks.exists(spark, state_path(warehouse, d)))


def drop_states(spark: SparkSession, warehouse: str, days: list[dt.date]) -> None:
    for d in days:
        sinks.drop_path(spark, state_path(warehouse, d))


def stored_state(spark: SparkSession, warehouse: str, day_base: DataFrame, boundary: dt.date,
                 changed: dt.date) -> tuple[DataFrame, dt.date]:
    """The user state as of a day up to ``boundary``, and that day.

    Days from ``changed`` on may differ from what an older version saw, so
    versions that reach them are dropped. The newest usable version is taken as
    it is while it lags by at most ``STATE_STRIDE``; otherwise it is advanced from
    the days in between (from all days if there is none), and the version before
    it is kept for late changes."""
    versions = state_versions(spark, warehouse)
    drop_states(spark, warehouse, [d for d in versions if d >= changed])
    versions = [d for d in versions if d < changed]
    usable = [d for d in versions if d <= boundary]
    as_of = usable[-1] if usable else None
    if as_of is None or boundary - as_of > STATE_STRIDE:
        new = (act.user_state(day_base, boundary) if as_of is None else
               act.advance_user_state(spark.read.parquet(state_path(warehouse, as_of)), day_base, as_of, boundary))
        new.write.mode("overwrite").parquet(state_path(warehouse, boundary))
        drop_states(spark, warehouse, usable[:-1])
        as_of = boundary
    return spark.read.parquet(state_path(warehouse, as_of)), as_of


def rebuild_state(spark: SparkSession, warehouse: str, day_base: DataFrame, params: RunParams) -> None:
    """After a full build: one state, old enough for the runs to come."""
    newest = sinks.max_partition_date(spark, table_path(warehouse, DAY_BASE), LAYOUT[DAY_BASE][0])
    drop_states(spark, warehouse, state_versions(spark, warehouse))
    if newest is not None:
        lag = dt.timedelta(days=max(params.period_lookback_days, 31) + params.late_arrival_lookback_days)
        boundary = newest - lag - 2 * act.LONGEST_PERIOD
        act.user_state(day_base, boundary).write.mode("overwrite").parquet(state_path(warehouse, boundary))


PERIOD_MARTS = ("user_period_activity", "fct_growth_accounting", "fct_engagement_depth",
                "fct_cohort_retention_triangle")


def refresh_periods(spark: SparkSession, warehouse: str, params: RunParams = RunParams(),
                    concurrency: int = 4, changed_since: dt.datetime | None = None,
                    on_step: Callable[[str, str], None] = no_step) -> dict:
    """Period marts from the stored daily user-segment base.

    First build, full refresh, or unknown change window: classify the whole
    history. Incremental run (every mart exists and ``changed_since``, the
    event window of the run, is known): classify only recent periods, from the
    days since the stored user state and that state (``classify_since``). Growth, activity and engagement rewrite the periods
    after their lookback window; the triangle rewrites every cell whose
    activity period starts after both its lookback window and the start of
    the month holding the first changed day - older cells cannot have changed,
    so the merged cohorts equal a full rebuild. The classified activity is
    materialised once and the four independent marts run as concurrent jobs.
    """
    ensure_utc(spark)
    owed = sinks.pending(spark, warehouse, "base")
    if owed or not sinks.exists(spark, table_path(warehouse, DAY_BASE)):
        refresh_day_base(spark, warehouse, None if not owed or None in owed else min(owed))
        sinks.clear_pending(spark, warehouse, "base")
    owed = sinks.pending(spark, warehouse, "periods")
    if changed_since is not None and owed:
        changed_since = None if None in owed else min(owed + [changed_since])
    day_base = read_table(spark, warehouse, DAY_BASE)
    upto = params.cutoff_date()
    afters = {name: period_lower_bound(spark, table_path(warehouse, name), LAYOUT[name][0], params)
              for name in PERIOD_MARTS}
    windowed = changed_since is not None and all(a is not None for a in afters.values())
    if windowed:
        d0 = changed_since.date()
        # earliest start of any period (day, Monday week, month) containing d0
        first_changed_period = min(d0 - dt.timedelta(days=d0.weekday()), d0.replace(day=1))
        # The triangle's partitions are cohorts, so its lookback counts from the newest activity period
        # (without new users the newest cohort stays behind, and the window would only grow).
        tri = "fct_cohort_retention_triangle"
        afters[tri] = min(afters["user_period_activity"], first_changed_period - dt.timedelta(days=1))
    if windowed:
        after = min(afters.values())
        state, as_of = stored_state(spark, warehouse, day_base, after - act.LONGEST_PERIOD, changed_since.date())
        classified = act.classify_since(day_base, after, state=state, as_of=as_of)
    else:
        classified = act.classify(act.user_period_segments(day_base))
    # carries event_count / miles_sum per user-period-segment, so the engagement mart reads it too
    activity, scratch = materialize(classified, spark, "activity")

    def triangle(after):
        if after is None:
            return cohort_retention_triangle(activity, upto)
        existing = read_table(spark, warehouse, "fct_cohort_retention_triangle")
        return cohort_retention_triangle_since(activity, existing, after, upto)

    builders = {
        "user_period_activity": lambda after: act.user_period_activity(activity, after, upto),
        "fct_growth_accounting": lambda after: growth_accounting(activity, after, upto),
        "fct_engagement_depth": lambda after: engagement_depth(activity, params.power_user_min_events,
                                                               after, upto),
        "fct_cohort_retention_triangle": triangle,
    }

    def put(name):
        path = table_path(warehouse, name)
        part, clus = LAYOUT[name]
        on_step(name, "before")
        out = builders[name](afters[name])
        if afters[name] is None:
            sinks.replace(out, path, part, clus)
        else:
            sinks.overwrite_partitions(out, path, part, cluster_by=clus)
        on_step(name, "after")

    try:
        with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
            for f in [pool.submit(put, name) for name in PERIOD_MARTS]:
                f.result()
    finally:
        sinks.drop_path(spark, scratch)   # run-scoped intermediate
    if not windowed:
        rebuild_state(spark, warehouse, day_base, params)
    sinks.clear_pending(spark, warehouse, "periods")
    return dict(afters)


def pre_checks(raw: DataFrame, params: RunParams = RunParams(),
               duplicate_severity: str = "error", since: dt.datetime | None = None) -> list:
    """Gate before any transform: source rows on the cutoff date, and no two
    source rows with the same event identity (either failure stops the run).

    ``since`` limits the duplicate scan to the source rows a run will read
    (event time after its lower bound); by default the whole source is
    checked, as the gate always did.
    """
    dup_input = raw if since is None else time_window(raw, "event_time", since, None)
    return [dq.Check("source_availability", dq.source_availability(raw, params.execution_date), stage="pre"),
            dq.Check("source_duplicates", dq.source_duplicates(dup_input), severity=duplicate_severity,
                     stage="pre")]


def post_checks(spark: SparkSession, raw: DataFrame, warehouse: str, params: RunParams = RunParams(),
                event_types: tuple[str, ...] = dq.REFERENCE_EVENT_TYPES) -> list:
    """Declared and singular checks over the stored tables (Parquet scans)."""
    t = {n: read_table(spark, warehouse, n) for n in TABLES}
    suite = dq.standard_suite(raw, t["stg_events"], t["dim_users"], t["fct_events"],
                              t["user_period_activity"], t["fct_growth_accounting"],
                              t["fct_cohort_retention_triangle"], t["fct_engagement_depth"],
                              params.execution_date, event_types=event_types)
    suite.append(dq.Check("day_base_matches_fact",
                          dq.base_matches_fact(read_table(spark, warehouse, DAY_BASE), t["fct_events"])))
    return [c for c in suite if getattr(c, "stage", "post") == "post"]


def refresh_all(spark: SparkSession, raw: DataFrame, warehouse: str,
                params: RunParams = RunParams(), run_quality: bool = True,
                on_duplicate: str = "fail",
                event_types: tuple[str, ...] = dq.REFERENCE_EVENT_TYPES,
                precheck_scope: str = "all", on_step: Callable[[str, str], None] = no_step,
                check_scope: str = "changed", reconcile: bool = False) -> RefreshReport:
    """Pre-checks -> event models -> period marts -> post-checks.

    ``precheck_scope="window"`` checks source duplicates only among the rows
    this run reads (after the staging watermark minus the lookback) instead
    of the whole source. ``check_scope="changed"`` checks the partitions that
    were rewritten since they were last checked and adds the stored results of
    the others (``plans.check_ledger``); ``"all"`` runs the whole suite over
    everything. ``reconcile`` also keeps the distinct-user state and compares
    all grains with it (warnings).
    """
    checks_out = []
    if run_quality:
        since = None
        if precheck_scope == "window":
            since = event_lower_bound(spark, table_path(warehouse, "stg_events"), "event_time_utc",
                                 "event_date_utc", params)
        checks_out += dq.run_checks(pre_checks(raw, params, since=since))
    windows = refresh_events(spark, raw, warehouse, params, on_duplicate, on_step)
    windows.update(refresh_periods(spark, warehouse, params, changed_since=windows.pop("changed_since"), on_step=on_step))
    if run_quality and check_scope == "changed":
        from .check_ledger import check_changed, require
        checks_out += require(check_changed(spark, warehouse, event_types))
    elif run_quality:
        checks_out += dq.run_checks(post_checks(spark, raw, warehouse, params, event_types))
    if reconcile:
        checks_out += dq.run_checks(cross_grain_checks(spark, warehouse))
    return RefreshReport(windows, checks_out)


def cross_grain_checks(spark: SparkSession, warehouse: str, tolerance: float = 0.0) -> list:
    """Bring the stored distinct-user state up to date and compare every grain
    with it, and weekly and monthly totals with their days."""
    day_base = read_table(spark, warehouse, DAY_BASE)
    owed = sinks.pending(spark, warehouse, "distinct")
    known = sinks.exists(spark, table_path(warehouse, distinct.DAY_DISTINCT))
    if owed or not known:
        distinct.refresh_distinct(spark, warehouse, day_base, None if not known or None in owed else min(owed))
        sinks.clear_pending(spark, warehouse, "distinct")
    growth, eng = read_table(spark, warehouse, "fct_growth_accounting"), read_table(spark, warehouse, "fct_engagement_depth")
    users = distinct_users(distinct.stored_distinct(spark, warehouse))
    return [dq.Check("cross_grain_users", dq.cross_grain_users(growth, users, tolerance), severity="warn"),
            dq.Check("cross_grain_totals", dq.cross_grain_totals(eng, tolerance), severity="warn")]

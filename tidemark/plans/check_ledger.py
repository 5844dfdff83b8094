"""Post-checks of what a run rewrote, with stored results for the rest.

Almost every declared check can be decided partition by partition: an event id
holds its time, so equal ids lie in one date partition; a user id lies in one
bucket; the identities, bounds and flags are of single rows; the prior-period
identity of a period needs that period and the one before. So each partition's
failures are counted once and kept beside a signature of its files. A later run
lists the files, checks the partitions whose signature differs and adds the
stored counts of the others: where nothing was rewritten it scans no table, and
a fault that was found stays reported until its partition is mended.

Every data file that Spark writes has a name of its own, so the names of a
partition's files are its signature; with them go the parameters of the checks
and, where a check looks at other partitions (``needs``), their signatures.

The ledger is a small Parquet table, one row for each partition and check, in
versions that count once they are complete.

Left to the full suite (``refresh.post_checks``): that a user's first time is
the minimum over all its events. Here every event of a checked partition is held
against its user's first time, and every user whose first time falls into a
checked partition must have an event there. And a dimension that loses users
shows in the fact partitions that are checked next, not in the others.
"""
from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality as dq
from ..operators.activity import SEGMENTS
from ..session import join_path
from . import sinks
from .refresh import DAY_BASE, LAYOUT, TABLES, table_path

LEDGER = "_checks"
ROWS = "table string, partition string, signature string, check string, severity string, failures long"
#: Checks of all partitions of a table read the dimension whole; it has one row for each user.
CHECKED = (*TABLES, DAY_BASE)


@dataclass(frozen=True)
class PartitionCheck:
    """``failing(changed, whole)`` gives the failing rows, with the partition
    column, of the rows in ``changed``; ``whole`` reads any table."""
    table: str
    name: str
    failing: Callable[[DataFrame, Callable[[str], DataFrame]], DataFrame]
    severity: str = "error"
    #: n_records of a failing row is the number of failures it stands for.
    weighted: bool = False


def _repeats(df: DataFrame, key: str, part: str, hex_key: bool) -> DataFrame:
    value = F.unhex(key) if hex_key else F.col(key)
    return (df.select(part, value.alias("k")).filter("k IS NOT NULL").groupBy(part, "k").count().filter("count > 1"))


def _orphans(df: DataFrame, key: str, part: str, dim: DataFrame) -> DataFrame:
    per_key = df.filter(F.col(key).isNotNull()).groupBy(part, key).agg(F.count(F.lit(1)).alias("n_records"))
    return per_key.join(dim.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def _first_events(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """Users and days of checked partitions with an event before the user's first
    time, or without one at it."""
    part = "event_date_utc"
    first = fct.groupBy(part, "user_id").agg(F.min("event_time_utc").alias("least"))
    known = dim.select("user_id", "first_event_time_utc")
    early = first.join(known, "user_id").filter("least < first_event_time_utc").select(part)
    days = fct.select(part).distinct()
    starts = known.select("user_id", "first_event_time_utc", F.to_date("first_event_time_utc").alias(part)).join(days, part, "left_semi")
    lacking = (starts.join(first, [part, "user_id"], "left")
               .filter("least IS NULL OR least > first_event_time_utc").select(part))
    return early.unionByName(lacking)


def _counted_days(base: DataFrame, whole) -> DataFrame:
    days = base.groupBy("activity_date").agg(F.sum("event_count").alias("stored"))
    chosen = days.select(F.col("activity_date").alias("event_date_utc"))
    events = whole("fct_events").join(chosen, "event_date_utc", "left_semi").groupBy("event_date_utc").count()
    return days.join(events, F.col("activity_date") == F.col("event_date_utc"), "left").filter(
        F.col("stored") != F.coalesce("count", F.lit(0)))


def _prior_identity(changed: DataFrame, whole) -> DataFrame:
    """Of the checked periods, with the periods before them read for comparison."""
    keys = ["period_grain", *SEGMENTS]
    current = changed.select(*keys, "period_start", "retained_users", "churned_users",
                             dq.prior_period_start(F.col("period_grain"), F.col("period_start")).alias("before"))
    needed = current.select(F.col("before").alias("period_start")).distinct()
    prior = (whole("fct_growth_accounting").join(needed, "period_start", "left_semi")
             .select(*keys, F.col("period_start").alias("before"), F.col("active_users").alias("prior_active")))
    return current.join(prior, [*keys, "before"]).filter("prior_active <> retained_users + churned_users")


def partition_checks(event_types: tuple[str, ...], country_severity: str = "warn") -> list[PartitionCheck]:
    """The declared suite as checks of partitions, under the names it has there."""
    out: list[PartitionCheck] = []

    def add(table, name, failing, **kw):
        out.append(PartitionCheck(table, name, failing, **kw))

    def rows(table, name, fn, **kw):
        add(table, name, lambda df, _: fn(df), **kw)

    required = {
        "stg_events": ("event_id", "event_time_utc", "user_id", "event_type"),
        "dim_users": ("user_sk", "user_id", "first_event_time_utc"),
        "fct_events": ("event_id", "user_sk", "user_id", "event_time_utc"),
        "user_period_activity": ("period_grain", "period_start", *SEGMENTS, "user_id"),
        "fct_growth_accounting": None, "fct_cohort_retention_triangle": None, "fct_engagement_depth": None,
    }
    for table, columns in required.items():
        short = table.removeprefix("fct_") if columns is None else table
        add(table, f"{short}_not_null", lambda df, _, c=columns: _nulls(df, c or df.columns), weighted=True)
    add("stg_events", "stg_events_not_null_country", lambda df, _: _nulls(df, ("country",)), severity=country_severity, weighted=True)
    day = "event_date_utc"
    rows("stg_events", "stg_events_unique_event_id", lambda df: _repeats(df, "event_id", day, True))
    rows("stg_events", "stg_events_accepted_event_type", lambda df: dq.accepted_values(df, "event_type", event_types))
    rows("stg_events", "stg_events_accepted_platform", lambda df: dq.accepted_values(df, "platform", dq.PLATFORMS))
    rows("dim_users", "dim_users_unique_user_sk", lambda df: _repeats(df, "user_sk", "user_bucket", True))
    rows("dim_users", "dim_users_unique_user_id", lambda df: _repeats(df, "user_id", "user_bucket", False))
    rows("fct_events", "fct_events_unique_event_id", lambda df: _repeats(df, "event_id", day, True))
    for key in ("user_sk", "user_id"):
        add("fct_events", f"fct_events_relationship_{key}",
            lambda df, whole, k=key: _orphans(df, k, day, whole("dim_users")), weighted=True)
    add("fct_events", "dim_first_event", lambda df, whole: _first_events(df, whole("dim_users")))
    add(DAY_BASE, "day_base_matches_fact", _counted_days)
    growth = "fct_growth_accounting"
    for prefix, top in (("growth", True), ("growth_segmented", False)):
        rows(growth, f"{prefix}_identity", lambda df, t=top: dq.growth_identity(df, t))
        rows(growth, f"{prefix}_non_negative", lambda df, t=top: dq.growth_non_negative(df, t))
        add(growth, f"{prefix}_prior_identity", lambda df, whole, t=top: _prior_identity(dq._topline(df) if t else df, whole))
    rows("user_period_activity", "classification_exclusive", dq.classification_exclusive)
    rows("fct_cohort_retention_triangle", "triangle_bounds", dq.triangle_bounds)
    rows("fct_cohort_retention_triangle", "triangle_unique", dq.triangle_unique)
    rows("fct_engagement_depth", "engagement_bounds", dq.engagement_bounds)
    for table, grain in (("user_period_activity", "period_grain"), (growth, "period_grain"),
                         ("fct_cohort_retention_triangle", "cohort_grain"), ("fct_engagement_depth", "period_grain")):
        rows(table, f"{table.removeprefix('fct_')}_accepted_{grain}", lambda df, g=grain: dq.accepted_values(df, g, dq.GRAIN_VALUES))
    return out


def _nulls(df: DataFrame, columns) -> DataFrame:
    """Rows with a null in any of the columns, and how many they have."""
    n = sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0).cast("long"))
    return df.withColumn("n_records", n).filter("n_records > 0")


# --------------------------------------------------------------------------- signatures
def partition_files(spark: SparkSession, warehouse: str, table: str) -> dict[str, str]:
    """A digest of the file names of each partition, from the file listing."""
    path, part = table_path(warehouse, table), LAYOUT[table][0]
    if not sinks.exists(spark, path):
        return {}
    # All names in one answer of the JVM: one call for each would take a while for many files.
    listed = json.loads(spark.sparkContext._jvm.com.fasterxml.jackson.databind.ObjectMapper()
                        .writeValueAsString(spark.read.parquet(path)._jdf.inputFiles()))
    found: dict[str, list[str]] = {}
    for f in listed:
        head, _, name = f.rpartition("/")
        value = head.rpartition(f"/{part}=")[2]
        found.setdefault(value, []).append(name)
    return {v: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest()[:32] for v, n in found.items()}


def _before(value: str) -> list[str]:
    """The periods that a period's prior-period identity may look at."""
    d = dt.date.fromisoformat(value)
    month = (d.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    return [str(d - dt.timedelta(days=1)), str(d - dt.timedelta(days=7)), str(month)]


def signatures(spark: SparkSession, warehouse: str, settings: str) -> dict[str, dict[str, str]]:
    """What the results of each table's partitions depend on."""
    files = {t: partition_files(spark, warehouse, t) for t in CHECKED}
    out = {}
    for table, parts in files.items():
        needs = {"fct_growth_accounting": lambda v: [parts.get(b, "") for b in _before(v)] if v[:1].isdigit() else [],
                 DAY_BASE: lambda v: [files["fct_events"].get(v, "")]}.get(table, lambda v: [])
        out[table] = {v: hashlib.sha256("|".join([settings, s, *needs(v)]).encode()).hexdigest()[:32] for v, s in parts.items()}
    return out


# --------------------------------------------------------------------------- the ledger
@dataclass(frozen=True)
class CheckReport:
    #: (check, severity, failures), totals over all partitions
    totals: list[tuple[str, str, int]]
    #: partitions that were read for it, by table
    checked: dict[str, list[str]]
    #: (check, partition, failures) of what fails
    failing: list[tuple[str, str, int]]


def _versions(spark: SparkSession, warehouse: str) -> list[int]:
    folder = join_path(warehouse, LEDGER)
    found = [int(v) for v in sinks.partition_values(spark, folder, "version")]
    return sorted(v for v in found if sinks.exists(spark, join_path(folder, f"version={v}")))


def ledger_rows(spark: SparkSession, warehouse: str) -> DataFrame:
    """The newest complete version (no rows before the first)."""
    versions = _versions(spark, warehouse)
    if not versions:
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).parquet(join_path(warehouse, LEDGER, f"version={versions[-1]}"))


def _failures(spark: SparkSession, warehouse: str, checks: list[PartitionCheck], changed: dict[str, list[str]]) -> dict:
    """{(table, partition, check): failures} of the changed partitions: one
    query, whose branches read the changed partitions of their table only."""
    def whole(table: str) -> DataFrame:
        return spark.read.parquet(table_path(warehouse, table))
    parts = None
    for c in checks:
        if not changed.get(c.table):
            continue
        part = LAYOUT[c.table][0]
        df = whole(c.table)
        kind = df.schema[part].dataType
        df = df.filter(F.col(part).isin([F.lit(v).cast(kind) for v in changed[c.table]]))
        n = F.sum("n_records") if c.weighted else F.count(F.lit(1))
        rows = c.failing(df, whole).groupBy(F.col(part).cast("string").alias("partition")).agg(n.cast("long").alias("failures"))
        rows = rows.select(F.lit(c.table).alias("table"), "partition", F.lit(c.name).alias("check"), "failures")
        parts = rows if parts is None else parts.unionByName(rows)
    return {} if parts is None else {(r.table, r.partition, r.check): r.failures for r in parts.collect()}


def check_changed(spark: SparkSession, warehouse: str, event_types: tuple[str, ...] = dq.REFERENCE_EVENT_TYPES,
                  country_severity: str = "warn") -> CheckReport:
    """Check the partitions that differ from what the ledger has seen, record
    their results, and report totals over all partitions."""
    checks = partition_checks(event_types, country_severity)
    settings = hashlib.sha256(repr((sorted(event_types), [(c.table, c.name, c.severity) for c in checks])).encode()).hexdigest()
    now = signatures(spark, warehouse, settings)
    old = ledger_rows(spark, warehouse)
    had = {(r.table, r.partition): r.signature for r in old.select("table", "partition", "signature").distinct().collect()}
    changed = {t: sorted(v for v, s in parts.items() if had.get((t, v)) != s) for t, parts in now.items()}
    changed = {t: v for t, v in changed.items() if v}
    gone = [k for k in had if k[1] not in now.get(k[0], {})]
    if changed or gone:
        found = _failures(spark, warehouse, checks, changed)
        new = [(t, v, now[t][v], c.name, c.severity, found.get((t, v, c.name), 0))
               for t, values in changed.items() for v in values for c in checks if c.table == t]
        stale = spark.createDataFrame([(t, v) for t, values in changed.items() for v in values] + gone, "table string, partition string")
        version = (_versions(spark, warehouse) or [0])[-1] + 1
        path = join_path(warehouse, LEDGER, f"version={version}")
        (old.join(stale, ["table", "partition"], "left_anti").unionByName(spark.createDataFrame(new, ROWS)).coalesce(1)
         .write.mode("overwrite").parquet(path))
        for v in _versions(spark, warehouse)[:-2]:
            sinks.drop_path(spark, join_path(warehouse, LEDGER, f"version={v}"))
        old = ledger_rows(spark, warehouse)
    totals = old.groupBy("check", "severity").agg(F.sum("failures").alias("n")).collect()
    failing = old.filter("failures > 0").select("check", "partition", "failures").collect()
    return CheckReport(sorted((r.check, r.severity, int(r.n)) for r in totals), changed, sorted(tuple(r) for r in failing))


def require(report: CheckReport) -> list[tuple[str, str, int]]:
    """The totals; raises if a check of severity ``error`` has failures."""
    failed = [(n, k) for n, severity, k in report.totals if severity == "error" and k]
    if failed:
        raise dq.DataQualityError("data-quality checks failed: " + ", ".join(f"{n} ({k} rows)" for n, k in failed))
    return report.totals

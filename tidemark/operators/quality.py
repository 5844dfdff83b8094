"""Data-quality checks.

Every check is a function returning the *failing rows* as a DataFrame (zero
rows = pass). ``summarize`` turns a set of checks into one small
``(check, failures)`` DataFrame evaluated in a single job, and
``run_checks`` raises when any check with severity ``error`` fails.

Generic checks: not_null, unique, accepted_values, relationships.
Singular checks: source availability and duplicates (run before the
transforms), dimension/fact consistency, growth identities, classification
exclusivity, triangle and engagement bounds.
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean_text, event_key, next_period_start, prior_period_start, ts_ntz
from ..functions import sqlexpr as sx
from .activity import ALL, SEGMENTS

# Fixed accepted-value sets of the reference contract.
REFERENCE_EVENT_TYPES = ("miles_earned", "miles_redeemed", "like", "share", "reward_search")
PLATFORMS = ("ios", "android", "web")
GRAIN_VALUES = ("daily", "weekly", "monthly")


# --------------------------------------------------------------------------- generic
def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """All not-null checks of one table fused into a single pass:
    one row per column with its null count."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "failures")


def repeated_values(df: DataFrame, value: Column, name: str, count_name: str,
                    hex_key: bool = False) -> DataFrame:
    """Values of ``value`` occurring more than once, with their counts.

    One scan and one aggregate, counted map-side before its shuffle. With
    ``hex_key`` (md5 keys in hex) the key is shuffled as its 16 bytes.
    """
    key = F.unhex(value) if hex_key else value
    counted = (df.select(key.alias(name)).filter(F.col(name).isNotNull())
               .groupBy(name).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1))
    return counted.withColumn(name, F.lower(F.hex(name))) if hex_key else counted


def unique(df: DataFrame, col: str, hex_key: bool = False) -> DataFrame:
    """Key values that occur more than once (nulls ignored)."""
    return repeated_values(df, F.col(col), col, "n_records", hex_key)


def accepted_values(df: DataFrame, col: str, values: tuple[str, ...]) -> DataFrame:
    """Rows whose value is outside ``values`` (null passes)."""
    return df.filter(~F.col(col).isin(list(values)))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-null child keys without a parent row, with the number of child
    rows carrying each (``n_records``; the check fails by their sum).

    Child rows are counted per key before the anti join (combined map-side),
    so an event-level child is reduced to its distinct keys before any
    shuffle against the parent.
    """
    keys = parent.select(F.col(parent_col).alias("_parent_key")).filter(F.col("_parent_key").isNotNull())
    per_key = (child.filter(F.col(col).isNotNull()).groupBy(col)
               .agg(F.count(F.lit(1)).alias("n_records")))
    return per_key.join(keys, F.col(col) == F.col("_parent_key"), "left_anti")


# --------------------------------------------------------------------------- source
def source_availability(raw: DataFrame, execution_date: str | None) -> DataFrame:
    """One failing row when a cutoff is given and no raw event falls on its day. The scan stops at the first matching row (``limit(1)``)."""
    spark = raw.sparkSession
    if execution_date is None or not str(execution_date).strip():
        return spark.createDataFrame([], "cutoff string, problem string")
    day = dt.datetime.fromisoformat(str(execution_date).strip())
    if day.tzinfo is not None:
        day = day.astimezone(dt.timezone.utc).replace(tzinfo=None)
    day = day.date()
    t = F.col("event_time").cast("timestamp_ntz")
    start = dt.datetime.combine(day, dt.time())
    hits = (raw.filter((t >= ts_ntz(start)) & (t < ts_ntz(start + dt.timedelta(days=1))))
            .limit(1).agg(F.count(F.lit(1))))
    probe = spark.range(1).select(F.lit(str(execution_date)).alias("cutoff"),
                                  F.lit("the raw table is empty for the cutoff's day").alias("problem"))
    return probe.filter(hits.scalar() == 0)


def event_signature(raw: DataFrame) -> Column:
    return event_key(F.col("event_time").cast("timestamp_ntz"), F.col("user_id").cast("string"),
                     clean_text(F.col("event_type"), "lower"), F.col("miles_amount"),
                     clean_text(F.col("platform"), "lower"))


def source_duplicates(raw: DataFrame) -> DataFrame:
    """Raw rows sharing the event identity (time, user, type, miles, platform)."""
    return repeated_values(raw, event_signature(raw), "event_signature", "duplicate_count", hex_key=True)


# --------------------------------------------------------------------------- marts
def dim_first_event(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """Users whose dimension first time differs from the fact's minimum."""
    expected = fct.groupBy("user_id").agg(F.min("event_time_utc").alias("min_event_time_utc"))
    return (dim.select("user_id", "first_event_time_utc").join(expected, "user_id")
            .filter(F.col("first_event_time_utc") != F.col("min_event_time_utc")))


def base_matches_fact(day_base: DataFrame, fct: DataFrame) -> DataFrame:
    """Days on which the daily user-segment base and the fact hold different
    numbers of events (a day missing on either side counts as zero)."""
    stored = day_base.groupBy(F.col("activity_date").alias("day")).agg(F.sum("event_count").alias("base_events"))
    actual = fct.groupBy(F.col("event_date_utc").alias("day")).agg(F.count(F.lit(1)).alias("fact_events"))
    return stored.join(actual, "day", "full_outer").filter(
        F.coalesce("base_events", F.lit(0)) != F.coalesce("fact_events", F.lit(0)))


def _topline(df: DataFrame) -> DataFrame:
    return df.filter((F.col("country") == ALL) & (F.col("platform") == ALL) & (F.col("utm_source") == ALL))


def growth_identity(growth: DataFrame, topline_only: bool = False) -> DataFrame:
    g = _topline(growth) if topline_only else growth
    return g.filter(F.col("active_users")
                    != F.col("new_users") + F.col("retained_users") + F.col("resurrected_users"))


def growth_prior_identity(growth: DataFrame, topline_only: bool = False) -> DataFrame:
    """Where the prior period has a row: prior active = retained + churned."""
    g = _topline(growth) if topline_only else growth
    keys = ["period_grain", *SEGMENTS]
    prior = g.select(*keys, F.col("period_start").alias("_prior_start"),
                     F.col("active_users").alias("prior_active_users"))
    cur = g.select(*keys, "period_start", "retained_users", "churned_users",
                   prior_period_start(F.col("period_grain"), F.col("period_start")).alias("_prior_start"))
    return (cur.join(prior, [*keys, "_prior_start"], "inner")
            .filter(F.col("prior_active_users") != F.col("retained_users") + F.col("churned_users"))
            .drop("_prior_start"))


def growth_non_negative(growth: DataFrame, topline_only: bool = False) -> DataFrame:
    g = _topline(growth) if topline_only else growth
    metrics = ["active_users", "new_users", "retained_users", "resurrected_users", "churned_users"]
    bad = None
    for m in metrics:
        c = F.col(m)
        cond = (c < 0) | (c.cast("double") != c.cast("long").cast("double"))
        bad = cond if bad is None else bad | cond
    return g.filter(bad)


def classification_exclusive(activity: DataFrame) -> DataFrame:
    n = (F.col("is_new").cast("int") + F.col("is_retained").cast("int")
         + F.col("is_resurrected").cast("int"))
    return activity.filter(n > 1)


def triangle_bounds(tri: DataFrame) -> DataFrame:
    return tri.filter((F.col("period_index") < 0) | (F.col("cohort_users") <= 0)
                      | (F.col("retained_users") < 0)
                      | (F.col("retained_users") > F.col("cohort_users"))
                      | (F.col("retention_rate") < 0) | (F.col("retention_rate") > 1))


def triangle_unique(tri: DataFrame) -> DataFrame:
    keys = ["cohort_grain", "cohort_start", "activity_period_start", "period_index", *SEGMENTS]
    return tri.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def engagement_bounds(eng: DataFrame) -> DataFrame:
    c = F.col
    return eng.filter((c("total_events") < 0) | (c("active_users") < 0) | (c("power_users") < 0)
                      | (c("power_users") > c("active_users")) | (c("events_per_active_user") < 0)
                      | (c("avg_miles_per_active_user") < 0) | (c("power_user_share") < 0)
                      | (c("power_user_share") > 1))


# --------------------------------------------------------------------------- across grains
def cross_grain_users(growth: DataFrame, distinct: DataFrame, tolerance: float = 0.0,
                      settled_by: dt.date | None = None) -> DataFrame:
    """Periods of any grain whose active users differ from the union of their
    days' users by more than ``tolerance`` of it; a period that only one side has
    counts as zero users on the other. ``distinct`` comes from mergeable day
    state, not from user rows. With ``settled_by`` only periods that had ended by
    that date are compared."""
    keys = ["period_grain", "period_start", *SEGMENTS]
    rows = (growth.select(*keys, "active_users").join(distinct.select(*keys, "distinct_users"), keys, "full_outer")
            .select(*keys, F.coalesce("active_users", F.lit(0)).alias("active_users"),
                    F.coalesce("distinct_users", F.lit(0)).alias("distinct_users")))
    return _settled(rows, settled_by).filter(F.abs(F.col("active_users") - F.col("distinct_users")) > tolerance * F.col("distinct_users"))


def cross_grain_totals(engagement: DataFrame, tolerance: float = 0.0, settled_by: dt.date | None = None) -> DataFrame:
    """Weeks and months whose total events differ from the sum over their daily
    rows by more than ``tolerance`` of it (a missing side counts as zero)."""
    keys = ["period_grain", "period_start", *SEGMENTS]
    coarse = ", ".join(f"named_struct('period_grain', '{g}', 'period_start', {sx.period_start_for(g, 'day')})" for g in ("weekly", "monthly"))
    daily = (engagement.filter("period_grain = 'daily'").selectExpr(*SEGMENTS, "total_events", "period_start AS day")
             .selectExpr(*SEGMENTS, "total_events", f"inline(array({coarse}))")
             .groupBy(*keys).agg(F.sum("total_events").alias("daily_events")))
    rows = (engagement.filter("period_grain <> 'daily'").select(*keys, "total_events").join(daily, keys, "full_outer")
            .select(*keys, F.coalesce("total_events", F.lit(0)).alias("total_events"),
                    F.coalesce("daily_events", F.lit(0)).alias("daily_events")))
    return _settled(rows, settled_by).filter(F.abs(F.col("total_events") - F.col("daily_events")) > tolerance * F.col("daily_events"))


def _settled(rows: DataFrame, by: dt.date | None) -> DataFrame:
    return rows if by is None else rows.filter(F.expr(sx.next_period_start("period_grain", "period_start")) <= F.lit(by))


def rate_bounds(growth: DataFrame) -> DataFrame:
    """Rows whose retention or churn rate (of the prior period's active users,
    where there are any) is outside [0, 1]."""
    keys = ["period_grain", *SEGMENTS]
    prior = growth.filter("active_users > 0").select(
        *keys, F.col("active_users").alias("prior_active_users"), next_period_start(F.col("period_grain"), F.col("period_start")).alias("period_start"))
    rates = growth.join(prior, [*keys, "period_start"]).select(
        *keys, "period_start", *[(F.col(f"{m}_users") / F.col("prior_active_users")).alias(f"{n}_rate")
                                 for m, n in (("retained", "retention"), ("churned", "churn"))])
    return rates.filter(~F.col("retention_rate").between(0, 1) | ~F.col("churn_rate").between(0, 1))


# --------------------------------------------------------------------------- runner
@dataclass(frozen=True)
class Check:
    name: str
    failing_rows: DataFrame
    severity: str = "error"   # or "warn"
    stage: str = "post"       # "pre" runs before the transforms
    weighted: bool = False    # failing_rows holds per-key counts in n_records

    def counted(self) -> DataFrame:
        # rows pre-counted per key (relationships) carry their multiplicity
        n = (F.coalesce(F.sum("n_records"), F.lit(0)).cast("long")
             if self.weighted else F.count(F.lit(1)))
        return (self.failing_rows.agg(n.alias("failures"))
                .select(F.lit(self.name).alias("check"), F.lit(self.severity).alias("severity"),
                        F.lit(self.stage).alias("stage"), "failures"))


@dataclass(frozen=True)
class NotNullGroup:
    """All not-null checks of one table, evaluated in one pass over it."""
    table: str
    df: DataFrame
    columns: tuple[str, ...]
    severity: dict | None = None   # per-column override, default "error"
    stage: str = "post"

    def counted(self) -> DataFrame:
        sev = self.severity or {}
        counts = null_counts(self.df, list(self.columns))
        sev_col = F.col("column_name")
        sev_expr = F.lit("error")
        for c, v in sev.items():
            sev_expr = F.when(sev_col == c, F.lit(v)).otherwise(sev_expr)
        return counts.select(F.concat(F.lit(f"{self.table}_not_null_"), sev_col).alias("check"),
                             sev_expr.alias("severity"), F.lit(self.stage).alias("stage"),
                             F.col("failures").cast("long").alias("failures"))


def summarize(checks: list) -> DataFrame:
    """(check, severity, stage, failures) for all checks in one job: each
    branch is a global count over its own (pruned) input."""
    parts = [c.counted() for c in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class DataQualityError(RuntimeError):
    pass


def run_checks(checks: list, stage: str | None = None) -> list[tuple[str, str, int]]:
    """Evaluate the checks (optionally one stage); raise on error failures.

    Returns ``[(check, severity, failures)]``. Only the per-check counts -
    one small row each - reach the driver.
    """
    selected = [c for c in checks if stage is None or c.stage == stage]
    if not selected:
        return []
    rows = [(r["check"], r["severity"], int(r["failures"])) for r in summarize(selected).collect()]
    failed = [r for r in rows if r[1] == "error" and r[2] > 0]
    if failed:
        raise DataQualityError("data-quality checks failed: "
                               + ", ".join(f"{n} ({k} rows)" for n, _, k in failed))
    return rows


def standard_suite(raw: DataFrame, stg: DataFrame, dim: DataFrame, fct: DataFrame,
                   activity: DataFrame, growth: DataFrame, tri: DataFrame, eng: DataFrame,
                   execution_date: str | None = None,
                   event_types: tuple[str, ...] = REFERENCE_EVENT_TYPES,
                   country_severity: str = "warn") -> list[Check]:
    """The full declared + singular suite over one set of marts."""
    checks: list = [
        Check("source_availability", source_availability(raw, execution_date), stage="pre"),
        Check("source_duplicates", source_duplicates(raw), stage="pre"),
        NotNullGroup("raw_events", raw, ("event_time", "user_id")),
        NotNullGroup("stg_events", stg, ("event_id", "event_time_utc", "user_id", "event_type", "country"),
                     severity={"country": country_severity}),
        NotNullGroup("dim_users", dim, ("user_sk", "user_id", "first_event_time_utc")),
        NotNullGroup("fct_events", fct, ("event_id", "user_sk", "user_id", "event_time_utc")),
        NotNullGroup("user_period_activity", activity, ("period_grain", "period_start", *SEGMENTS, "user_id")),
        NotNullGroup("growth_accounting", growth, tuple(growth.columns)),
        NotNullGroup("cohort_retention_triangle", tri, tuple(tri.columns)),
        NotNullGroup("engagement_depth", eng, tuple(eng.columns)),
    ]
    checks += [
        Check("stg_events_unique_event_id", unique(stg, "event_id", hex_key=True)),
        Check("stg_events_accepted_event_type", accepted_values(stg, "event_type", event_types)),
        Check("stg_events_accepted_platform", accepted_values(stg, "platform", PLATFORMS)),
    ]
    checks += [Check("dim_users_unique_user_sk", unique(dim, "user_sk", hex_key=True)),
               Check("dim_users_unique_user_id", unique(dim, "user_id"))]
    checks += [
        Check("fct_events_unique_event_id", unique(fct, "event_id", hex_key=True)),
        Check("fct_events_relationship_user_sk", relationships(fct, "user_sk", dim, "user_sk"), weighted=True),
        Check("fct_events_relationship_user_id", relationships(fct, "user_id", dim, "user_id"), weighted=True),
        Check("dim_first_event", dim_first_event(dim, fct)),
        Check("growth_identity", growth_identity(growth, topline_only=True)),
        Check("growth_segmented_identity", growth_identity(growth)),
        Check("growth_prior_identity", growth_prior_identity(growth, topline_only=True)),
        Check("growth_segmented_prior_identity", growth_prior_identity(growth)),
        Check("growth_non_negative", growth_non_negative(growth, topline_only=True)),
        Check("growth_segmented_non_negative", growth_non_negative(growth)),
        Check("classification_exclusive", classification_exclusive(activity)),
        Check("triangle_bounds", triangle_bounds(tri)),
        Check("triangle_unique", triangle_unique(tri)),
        Check("engagement_bounds", engagement_bounds(eng)),
    ]
    for name, df, col in (("user_period_activity", activity, "period_grain"),
                          ("growth_accounting", growth, "period_grain"),
                          ("cohort_retention_triangle", tri, "cohort_grain"),
                          ("engagement_depth", eng, "period_grain")):
        checks.append(Check(f"{name}_accepted_{col}", accepted_values(df, col, GRAIN_VALUES)))
    return checks

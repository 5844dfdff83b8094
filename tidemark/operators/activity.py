"""User-period activity: the shared base of the growth, retention and
engagement marts.

Plan shape (one pass over the fact, no per-grain rescans, no self-joins):

  fct_events
    -> user_day_segments        groupBy(day, user, segment)     [shuffle 1, map-side combine]
    -> repartition(n, user_id)                                   [shuffle 2, post-aggregation]
    -> user_period_segments     inline 3 grains x {segment, all}; groupBy  (no shuffle)
    -> activity                 lag / lead / min over (grain, segment, user) (no shuffle)

Shuffle 1 pre-aggregates events, so a user with a huge share of events sends
at most one row per (day, segment) from each map task. After it a user owns
at most days x segments rows, which makes ``user_id`` a safe partitioning key
for everything downstream: the period aggregate and the window both require
a clustering that contains ``user_id``, so Spark reuses shuffle 2 for both.

Each row of shuffle 2 becomes six that the aggregates and the window's sort hold
in memory, so its tasks are dealt by the size of the input, not by the bytes
that were shuffled (``by_user``): a task's memory stays the same as the input grows.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import GRAINS
from ..functions import sqlexpr as sx
from ..session import input_bytes

SEGMENTS = ("country", "platform", "utm_source")
ALL = "all"
# Fixed labels of the reference contract for missing segment values.
UNKNOWN_COUNTRY = "UNKNOWN"
UNKNOWN_OTHER = "unknown"
PERIOD_KEYS = ("period_grain", "period_start", *SEGMENTS, "user_id")
# The user first: sorts compare the first key by a prefix, and most rows differ there.
ACTIVITY_KEYS = ("user_id", "period_grain", *SEGMENTS)
ACTIVITY_COLUMNS = ["period_grain", "period_start", *SEGMENTS, "user_id", "first_active_period",
                    "prior_period_start", "is_new", "is_resurrected", "is_retained"]
SEGMENT_LABELS_SQL = [f"coalesce(country, '{UNKNOWN_COUNTRY}') AS country",
                      f"coalesce(platform, '{UNKNOWN_OTHER}') AS platform",
                      f"coalesce(utm_source, '{UNKNOWN_OTHER}') AS utm_source"]


def segment_labels() -> list[Column]:
    return [F.expr(e) for e in SEGMENT_LABELS_SQL]


def user_day_segments(fct: DataFrame) -> DataFrame:
    """(activity_date, user_id, segment, event_count, miles_sum) per user-day-segment."""
    return (fct.selectExpr("event_date_utc AS activity_date", "user_id", *SEGMENT_LABELS_SQL, "miles_amount")
            .groupBy("activity_date", "user_id", *SEGMENTS)
            .agg(F.expr("count(1) AS event_count"),
                 F.expr("coalesce(sum(miles_amount), CAST(0 AS DECIMAL(38,9))) AS miles_sum")))


def grain_segment_variants(grains: tuple[str, ...] = GRAINS) -> str:
    """SQL generator: each user-day row once per grain for its own segment
    and once for the ``all/all/all`` roll-up."""
    structs = []
    for g in grains:
        p = sx.period_start_for(g, "activity_date")
        own = ", ".join(f"'{s}', {s}" for s in SEGMENTS)
        rolled = ", ".join(f"'{s}', '{ALL}'" for s in SEGMENTS)
        structs.append(f"named_struct('period_grain', '{g}', 'period_start', {p}, {own})")
        structs.append(f"named_struct('period_grain', '{g}', 'period_start', {p}, {rolled})")
    return f"inline(array({', '.join(structs)}))"


#: Bytes of input files for each task that classifies periods (some 100,000 user-days
#: of the driver's orders, which take about 350 MB as period rows).
INPUT_PER_TASK = 1 << 20


def by_user(rows: DataFrame) -> DataFrame:
    """User-day rows dealt by user for the period step.

    Spark would merge shuffled partitions by their bytes here, to about as many as
    there are cores; a number of partitions of our own it leaves alone. Small
    inputs are left to Spark."""
    tasks = -(-input_bytes(rows) // INPUT_PER_TASK)
    if tasks <= rows.sparkSession.sparkContext.defaultParallelism:
        return rows.repartition("user_id")
    return rows.repartition(tasks, "user_id")


def user_period_segments(day_base: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """One row per (grain, period, segment, user) with event_count, miles_sum.

    Every user-day row is emitted once per grain for its own segment and once
    for the ``all/all/all`` roll-up; the aggregate then sums days into
    periods and segments into ``all``. Only the full triple is rolled up (no
    partial ``SG/all/all`` rows).
    """
    rows = (by_user(day_base)
            .selectExpr("user_id", "event_count", "miles_sum", grain_segment_variants(grains)))
    return (rows.groupBy(*PERIOD_KEYS)
            .agg(F.expr("sum(event_count) AS event_count"), F.expr("sum(miles_sum) AS miles_sum")))


def activity_window() -> Window:
    return Window.partitionBy(*ACTIVITY_KEYS).orderBy("period_start")


_WINDOW_SQL = f"OVER (PARTITION BY {', '.join(ACTIVITY_KEYS)} ORDER BY period_start)"


def classify(periods: DataFrame) -> DataFrame:
    """Add new / retained / resurrected flags and neighbouring active periods.

    Per (grain, segment, user), ordered by period: the previous active period
    decides the class (none -> new; the prior period -> retained; earlier ->
    resurrected) and the next active period decides churn. One sort serves
    all window expressions.
    """
    return _classified(periods, f"min(period_start) {_WINDOW_SQL} AS first_active_period")


def _classified(periods: DataFrame, first_active_period: str) -> DataFrame:
    extra = [c for c in ("event_count", "miles_sum") if c in periods.columns]
    out = periods.selectExpr(
        *PERIOD_KEYS, *extra, first_active_period,
        f"{sx.prior_period_start('period_grain', 'period_start')} AS prior_period_start",
        f"lag(period_start) {_WINDOW_SQL} AS previous_active_period",
        f"lead(period_start) {_WINDOW_SQL} AS next_active_period",
    )
    return out.selectExpr(
        "*",
        "previous_active_period IS NULL AS is_new",
        "previous_active_period IS NOT NULL AND previous_active_period < prior_period_start AS is_resurrected",
        "previous_active_period IS NOT NULL AND previous_active_period = prior_period_start AS is_retained",
    )


def period_window(df: DataFrame, col: str, after: dt.date | None,
                  upto: dt.date | None) -> DataFrame:
    """Keep rows with ``after < col <= upto`` (either bound optional)."""
    if after is not None:
        df = df.filter(F.col(col) > F.lit(after))
    if upto is not None:
        df = df.filter(F.col(col) <= F.lit(upto))
    return df


def user_period_activity(activity: DataFrame, after: dt.date | None = None,
                         upto: dt.date | None = None) -> DataFrame:
    """Public P5 shape. Flags are computed on full history *before* the
    period window is applied (a window cannot push below the flags)."""
    return period_window(activity, "period_start", after, upto).select(*ACTIVITY_COLUMNS)


# --------------------------------------------------------------------------- windowed history
STATE_KEYS = ("user_id", *SEGMENTS)
#: The longest period: every period that starts more than this before a day has ended by it.
LONGEST_PERIOD = dt.timedelta(days=31)


def user_state(day_base: DataFrame, upto: dt.date, since: dt.date | None = None) -> DataFrame:
    """(user_id, segment, first_day, last_day) of the days up to ``upto`` (after
    ``since``): all that later periods need to know of a user's past, one row for
    each user and segment however long the past is."""
    days = day_base.filter(F.col("activity_date") <= F.lit(upto))
    if since is not None:
        days = days.filter(F.col("activity_date") > F.lit(since))
    return days.groupBy(*STATE_KEYS).agg(F.min("activity_date").alias("first_day"), F.max("activity_date").alias("last_day"))


def advance_user_state(state: DataFrame, day_base: DataFrame, since: dt.date, upto: dt.date) -> DataFrame:
    """``state`` as of ``since`` brought to ``upto``, from the days in between only."""
    return (state.select(*STATE_KEYS, "first_day", "last_day").unionByName(user_state(day_base, upto, since))
            .groupBy(*STATE_KEYS).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")))


def classify_since(day_base: DataFrame, after: dt.date, grains: tuple[str, ...] = GRAINS,
                   state: DataFrame | None = None, as_of: dt.date | None = None) -> DataFrame:
    """Classified activity rows for periods starting after ``after`` and some
    before, equal to ``classify`` over full history restricted to those periods.

    ``state`` is the stored user state as of ``as_of``, at least a month before
    ``after`` (so that every period whose churn is reported has its prior period
    present); only later days of the base are read. Without it the state is
    computed from the base. A user's past enters as one row in the last period
    that the state knows, carrying the first day; so it takes the ordinary way
    through the period aggregate and the window, with one exchange by user for
    state and days together and no join.
    """
    boundary = after - LONGEST_PERIOD if as_of is None else as_of
    if boundary > after - LONGEST_PERIOD:
        raise ValueError(f"a state as of {boundary} is too recent for periods after {after}")
    if state is None:
        state = user_state(day_base, boundary)
    variants = grain_segment_variants(grains)
    recent = (day_base.filter(F.col("activity_date") > F.lit(boundary))
              .selectExpr(*STATE_KEYS, "activity_date", "event_count", "miles_sum", "CAST(NULL AS DATE) AS first_day"))
    past = state.selectExpr(*STATE_KEYS, "last_day AS activity_date", "CAST(NULL AS BIGINT) AS event_count",
                            "CAST(NULL AS DECIMAL(38,9)) AS miles_sum", "first_day")
    rows = (by_user(recent.unionByName(past))
            .selectExpr("user_id", "event_count", "miles_sum", "first_day", variants))
    periods = rows.groupBy(*PERIOD_KEYS).agg(F.expr("sum(event_count) AS event_count"), F.expr("sum(miles_sum) AS miles_sum"),
                                             F.expr("min(first_day) AS first_day"))
    first = f"min(least(period_start, {sx.period_start('period_grain', 'first_day')})) {_WINDOW_SQL} AS first_active_period"
    # Periods that began by the boundary are there for the window only: their rows are not complete.
    return _classified(periods, first).filter(F.col("period_start") > F.lit(boundary))

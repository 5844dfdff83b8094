"""Core marts: the user dimension and the event fact."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import sqlexpr as sx
from ..params import RunParams
from .staging import time_window

DIM_COLUMNS = ["user_sk", "user_id", "first_event_time_utc", "first_event_date_utc",
               "latest_event_time_utc", "latest_event_date_utc", "latest_gender",
               "latest_platform", "latest_country", "latest_utm_source"]
FCT_COLUMNS = ["event_id", "user_sk", "user_id", "event_time_utc", "event_date_utc",
               "event_week_utc", "event_month_utc", "event_type", "transaction_category",
               "miles_amount", "gender", "platform", "utm_source", "country", "loaded_at"]
USER_ATTRIBUTES = ("gender", "platform", "country", "utm_source")


# Order of a user's events as one number: microseconds since 1970, then the
# first 15 hex digits of the event id (time ties go to the larger id).
EVENT_RANK = ("CAST(unix_micros(CAST(event_time_utc AS timestamp)) AS decimal(38,0)) * 10000000000000000000"
              " + CAST(conv(substring(event_id, 1, 15), 16, 10) AS decimal(20,0))")


def user_profile(events: DataFrame) -> DataFrame:
    """One row per user: first / latest event time and latest attributes.

    First one row per user and combination of attribute values, with the rank
    of its latest event as a decimal: a buffer of numbers, so this is a hash
    aggregate, combined map-side, and no event is sorted. The latest non-null
    value of each attribute is then chosen among a user's few combinations.
    """
    combos = (events.select("user_id", "event_time_utc", *USER_ATTRIBUTES, F.expr(EVENT_RANK).cast("decimal(38,0)").alias("rank"))
              .groupBy("user_id", *USER_ATTRIBUTES)
              .agg(F.min("event_time_utc").alias("first"), F.max("event_time_utc").alias("latest"),
                   F.max("rank").alias("rank")))
    return combos.groupBy("user_id").agg(
        F.min("first").alias("first_event_time_utc"), F.max("latest").alias("latest_event_time_utc"),
        *[F.expr(f"max_by({a}, CASE WHEN {a} IS NOT NULL THEN rank END) AS latest_{a}") for a in USER_ATTRIBUTES])


def _finish_dim(profile: DataFrame, *also: str) -> DataFrame:
    return profile.selectExpr(
        f"{sx.surrogate_key('user_id')} AS user_sk",
        "user_id",
        "first_event_time_utc",
        "to_date(first_event_time_utc) AS first_event_date_utc",
        "latest_event_time_utc",
        "to_date(latest_event_time_utc) AS latest_event_date_utc",
        *[f"latest_{a}" for a in USER_ATTRIBUTES],
        *also,
    )


def dim_users(stg: DataFrame, params: RunParams = RunParams(),
              after: dt.datetime | None = None) -> DataFrame:
    """User dimension rows for the users seen in the (windowed) staging input.
    A refresh merges them with the stored rows by ``merge_dim_rows``."""
    events = time_window(stg, "event_time_utc", after, params.cutoff_ts(), date_col="event_date_utc")
    return _finish_dim(user_profile(events.select("user_id", "event_time_utc", "event_id",
                                                  *USER_ATTRIBUTES)))


def merge_dim_rows(existing: DataFrame, incoming_profile: DataFrame, flag: str | None = None) -> DataFrame:
    """Existing dimension rows (of the touched buckets) merged with incoming
    user profiles in ONE full outer join: users only in ``existing`` keep
    their row, users only in ``incoming`` are inserted, users in both get the
    earliest first time, latest latest time and the incoming attribute when
    it is non-null. The result replaces those buckets whole, so the merge
    needs no second (anti) join against the table. ``flag`` names a column that
    says whether a row is new or differs from the stored one."""
    old = existing.selectExpr(
        "user_id", "first_event_time_utc AS _old_first", "latest_event_time_utc AS _old_latest",
        *[f"latest_{a} AS _old_{a}" for a in USER_ATTRIBUTES])
    merged = incoming_profile.join(old, "user_id", "full_outer").selectExpr(
        "user_id",
        "least(first_event_time_utc, _old_first) AS first_event_time_utc",
        "greatest(latest_event_time_utc, _old_latest) AS latest_event_time_utc",
        *[f"coalesce(latest_{a}, _old_{a}) AS latest_{a}" for a in USER_ATTRIBUTES],
        # what the old row lacks or has otherwise
        "_old_first IS NULL OR first_event_time_utc < _old_first OR latest_event_time_utc > _old_latest OR "
        + " OR ".join(f"(latest_{a} IS NOT NULL AND NOT latest_{a} <=> _old_{a})" for a in USER_ATTRIBUTES) + " AS _differs",
    )
    done = _finish_dim(merged, "_differs")
    return done.drop("_differs") if flag is None else done.selectExpr(*DIM_COLUMNS, f"coalesce(_differs, false) AS {flag}")


def missing_users(stg: DataFrame, dim: DataFrame, params: RunParams = RunParams(),
                  after: dt.datetime | None = None) -> DataFrame:
    """Users with events in the window but without a dimension row, from the
    distinct users (combined map-side), not the events."""
    events = time_window(stg, "event_time_utc", after, params.cutoff_ts(), date_col="event_date_utc")
    return events.select("user_id").distinct().join(dim.select("user_id"), "user_id", "left_anti")


def fct_events(stg: DataFrame, params: RunParams = RunParams(), after: dt.datetime | None = None,
               missing: DataFrame | None = None) -> DataFrame:
    """Event fact: staging rows plus the user's surrogate key.

    Semantics of a left join with the dimension on ``user_id``. The key is a
    pure function of ``user_id``, so no event is shuffled to look it up; only
    an event whose user is ``missing`` from the dimension has a null key (the
    relationship check reports it). Without ``missing`` the dimension is built
    from the same rows and holds every user. A refresh writes the missing
    users (normally none) to a table first, so that Spark knows their size
    and its own threshold decides how to join them.
    """
    events = time_window(stg, "event_time_utc", after, params.cutoff_ts(), date_col="event_date_utc")
    key = sx.surrogate_key("user_id")
    if missing is not None:
        events = events.join(missing.select("user_id", F.lit(True).alias("_missing")), "user_id", "left")
        key = f"CASE WHEN _missing THEN NULL ELSE {key} END"
    return events.withColumn("user_sk", F.expr(key)).select(*FCT_COLUMNS)

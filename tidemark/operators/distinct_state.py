"""Distinct users as mergeable state: one bitmap per day, segment and block of
user numbers.

Counts of distinct users don't add up over days, but sets of them merge: the
users of a week are the union of its days' users. With dense user numbers a set
is a row of 4 KB bitmaps, one for each block of 32,768 numbers that has a user,
and a union is a bitwise OR that Spark combines before its shuffle. So the
state is built from the user-level base once per day, and every coarser grain
and the all-segments roll-up are made from the state alone.

``SKETCH`` keeps a HyperLogLog sketch per day and segment instead: no user
numbers and a fixed size, but counts with a relative standard error of
``sketch_error``. It is an option for data whose users can't be numbered.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions import GRAINS
from ..functions import sqlexpr as sx
from .activity import ALL, SEGMENTS

#: Fixed: users in one bitmap of Spark's bitmap functions (4 KB).
BLOCK_USERS = 32_768
SKETCH_LOG_SIZE = 14
BITMAP, SKETCH = "bitmap", "sketch"
STATE_KEYS = ("activity_date", *SEGMENTS)


def day_bitmaps(day_base: DataFrame, numbers: DataFrame) -> DataFrame:
    """(activity_date, segment, block, users): the users of each day and segment.

    ``numbers`` gives each ``user_id`` its ``user_number``; the base has one row
    for each user, day and segment, so a frequent user costs no more than its
    days and segments here."""
    placed = day_base.select(*STATE_KEYS, "user_id").join(numbers.select("user_id", "user_number"), "user_id")
    return (placed.groupBy(*STATE_KEYS, F.expr(f"user_number div {BLOCK_USERS}").alias("block"))
            .agg(F.expr(f"bitmap_construct_agg(user_number % {BLOCK_USERS})").alias("users")))


def day_sketches(day_base: DataFrame, log_size: int = SKETCH_LOG_SIZE) -> DataFrame:
    """(activity_date, segment, users) with a HyperLogLog sketch as the users."""
    return (day_base.groupBy(*STATE_KEYS)
            .agg(F.hll_sketch_agg("user_id", F.lit(log_size)).alias("users")))


def sketch_error(log_size: int = SKETCH_LOG_SIZE) -> float:
    """The relative standard error of counts from sketches of this size."""
    return 1.04 / math.sqrt(2 ** log_size)


def with_all_segments(state: DataFrame) -> DataFrame:
    """The state with the union of each day's segments as ``all/all/all``."""
    rolled = _merged(state, ["activity_date"])
    return state.unionByName(rolled.select("*", *[F.lit(ALL).alias(s) for s in SEGMENTS]))


def _merged(state: DataFrame, keys: list) -> DataFrame:
    if "block" in state.columns:
        return state.groupBy(*keys, "block").agg(F.expr("bitmap_or_agg(users) AS users"))
    return state.groupBy(*keys).agg(F.hll_union_agg("users").alias("users"))


def distinct_users(state: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """(period_grain, period_start, segment, distinct_users) of all grains from
    day state. Days are merged into periods; no user row is read."""
    periods = ", ".join(f"named_struct('period_grain', '{g}', 'period_start', {sx.period_start_for(g, 'activity_date')})"
                        for g in grains)
    rest = [c for c in state.columns if c != "activity_date"]
    spread = state.selectExpr(*rest, f"inline(array({periods}))")
    keys = ["period_grain", "period_start", *SEGMENTS]
    merged = _merged(spread, keys)
    if "block" in state.columns:
        return merged.groupBy(*keys).agg(F.sum(F.expr("bitmap_count(users)")).cast("long").alias("distinct_users"))
    return merged.select(*keys, F.hll_sketch_estimate("users").alias("distinct_users"))

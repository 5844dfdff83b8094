"""Stored distinct-user state: dense user numbers and daily bitmaps.

  user_numbers/         user_id -> user_number, dense from 0, only ever added to
  user_day_distinct/    partitioned by activity_date (touched days rewritten)

A run numbers the users it hasn't seen and rebuilds the bitmaps of the days its
events touched; weeks and months are unions of stored days.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.activity import SEGMENTS
from ..operators.distinct_state import day_bitmaps, with_all_segments
from ..session import join_path, scratch_path
from . import sinks

USER_NUMBERS = "user_numbers"
DAY_DISTINCT = "user_day_distinct"
_LOW_BITS = (1 << 33) - 1


def number_users(spark: SparkSession, users: DataFrame, near: tuple[str, ...] = (), start: int = 0) -> tuple[DataFrame, str]:
    """(user_id, user_number) with numbers dense from ``start``, and the folder
    that holds them until the caller drops it.

    Users are dealt by ranges of ``near`` and user_id, so users that are alike
    there get neighbouring numbers and their bitmaps share blocks. A task's rows
    are numbered in place; the tasks' sizes, one row each, give the offsets. The
    rows are written once in between, so that both steps see the same deal.
    """
    path = scratch_path(spark, "user-numbers")
    (users.select("user_id", *near).repartitionByRange(*near, "user_id").sortWithinPartitions(*near, "user_id")
     .select("user_id", F.spark_partition_id().alias("deal"),
             F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)).alias("place"))
     .write.parquet(path))
    dealt = spark.read.schema("user_id string, deal int, place long").parquet(path)
    offsets = dealt.groupBy("deal").count().selectExpr(
        "deal", f"sum(count) OVER (ORDER BY deal) - count + {int(start)} AS before_deal")
    return dealt.join(offsets, "deal").select("user_id", (F.col("before_deal") + F.col("place")).alias("user_number")), path


def users_of(day_base: DataFrame) -> DataFrame:
    """The users of a daily base, each with one of its segments."""
    return day_base.groupBy("user_id").agg(F.min(F.struct(*SEGMENTS)).alias("s")).select("user_id", "s.*")


def distinct_days(spark: SparkSession, day_base: DataFrame) -> tuple[DataFrame, str]:
    """Day state of a base that isn't stored, and the folder to drop after use."""
    numbers, path = number_users(spark, users_of(day_base), SEGMENTS)
    return with_all_segments(day_bitmaps(day_base, numbers)), path


def refresh_distinct(spark: SparkSession, warehouse: str, day_base: DataFrame, after: dt.datetime | None) -> None:
    """Bring the stored state up to date with the stored daily base, from the day
    of ``after`` on (None: all days). Users keep the numbers they have, so a run
    that died in between is simply repeated."""
    p_numbers, p_days = join_path(warehouse, USER_NUMBERS), join_path(warehouse, DAY_DISTINCT)
    have = sinks.exists(spark, p_numbers)
    whole = after is None or not sinks.exists(spark, p_days)
    days = day_base if whole else day_base.filter(F.col("activity_date") >= F.lit(after.date()))
    users, start = users_of(days), 0
    if have:
        known = spark.read.parquet(p_numbers)
        users = users.join(known.select("user_id"), "user_id", "left_anti")
        start = (known.agg(F.max("user_number")).first()[0] or -1) + 1
    new, scratch = number_users(spark, users, SEGMENTS, start)
    new.write.mode("append").parquet(p_numbers)
    sinks.drop_path(spark, scratch)
    state = with_all_segments(day_bitmaps(days, spark.read.parquet(p_numbers)))
    if whole:
        sinks.replace(state, p_days, "activity_date", SEGMENTS)
    else:
        sinks.overwrite_partitions(state, p_days, "activity_date", SEGMENTS)


def stored_distinct(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.parquet(join_path(warehouse, DAY_DISTINCT))

"""Freshness and cutoff compliance without scanning tables.

When something was last loaded is noted by each load in its ledger; which days a
stored table holds is its partition listing. Neither opens a data file. Only
when a table's newest partition is the cutoff's own day must rows be looked at,
and then of that partition, with the time pushed into the scan, so row groups
that end before the cutoff are skipped by their statistics.

Both give failing rows, as every check does.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import ts_ntz
from ..sources.loads import load_bounds
from . import sinks

STALE = "source string, last_loaded_at timestamp_ntz, last_event_time timestamp_ntz, problem string"
BEYOND = "partition_day date, rows long, problem string"


def stale_source(spark: SparkSession, table: str, now: dt.datetime, max_age: dt.timedelta,
                 max_event_age: dt.timedelta | None = None) -> DataFrame:
    """A row for each way in which an append-loaded table is stale at ``now``:
    never loaded, last loaded more than ``max_age`` ago, or (with
    ``max_event_age``) its newest event older than that."""
    bounds = load_bounds(spark, table)
    loaded, event = bounds["max_loaded_at"], bounds["max_event_time"]
    found = []
    if loaded is None:
        found.append("nothing has been loaded")
    elif now - loaded > max_age:
        found.append(f"last loaded more than {max_age} ago")
    if max_event_age is not None and event is not None and now - event > max_event_age:
        found.append(f"the newest event is more than {max_event_age} old")
    return spark.createDataFrame([(table, loaded, event, p) for p in found], STALE)


def beyond_cutoff(spark: SparkSession, path: str, day_column: str, cutoff: dt.datetime,
                  time_column: str | None = None) -> DataFrame:
    """Partitions of a stored table with days after the cutoff's, and (with
    ``time_column``) the number of rows of its own day that are later. A null
    ``rows`` means that the partition's name was enough."""
    days = sorted(dt.date.fromisoformat(v) for v in sinks.partition_values(spark, path, day_column)
                  if v != "__HIVE_DEFAULT_PARTITION__")
    late = spark.createDataFrame([(d, None, "the day is after the cutoff") for d in days if d > cutoff.date()], BEYOND)
    if time_column is None or cutoff.date() not in days:
        return late
    rows = (spark.read.parquet(path).filter((F.col(day_column) == F.lit(cutoff.date())) & (F.col(time_column) > ts_ntz(cutoff)))
            .agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0"))
    return late.unionByName(rows.select(F.lit(cutoff.date()).alias("partition_day"), "rows", F.lit("events after the cutoff").alias("problem")))

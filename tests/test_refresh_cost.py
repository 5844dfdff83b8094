"""What a refresh must not do twice, and that its cheaper steps give the same rows."""
import datetime as dt
import os

import pytest
from pyspark.sql import DataFrame, functions as F

from tidemark.plans import refresh, sinks

from conftest import make_raw


def test_merge_replaces_what_it_reads_without_a_copy(spark, tmp_path, monkeypatch):
    """The rows of a merge are not written to a checkpoint before they are written to the table."""
    path, schema = str(tmp_path / "t"), "k string, v int, p int"
    sinks.replace(spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 2)], schema), path, "p")

    def no_copy(*a, **b):
        raise AssertionError("a merge needs no checkpoint")
    monkeypatch.setattr(DataFrame, "checkpoint", no_copy)
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", no_copy)
    for n in (2, 3):
        sinks.upsert(spark, path, spark.createDataFrame([("b", n, 1), ("d", n, 1)], schema), "k", "p")
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect())) == [
        ("a", 1, 1), ("b", 3, 1), ("c", 1, 2), ("d", 3, 1)]


def test_a_merge_that_fails_leaves_the_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v int, p int"
    rows = [(f"k{i}", 1, i % 3) for i in range(30)]
    sinks.replace(spark.createDataFrame(rows, schema), path, "p")
    bad = spark.createDataFrame([("k1", 5, 1), ("k2", 0, 2)], schema).withColumn("v", F.expr("CAST(10 / v AS INT)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.overwrite_partitions(spark.read.parquet(path).unionByName(bad).select("k", "v", "p"), path, "p")
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect())) == sorted(rows)


def test_a_dimension_merge_writes_one_file_for_each_bucket(spark, tmp_path):
    wh, setting = str(tmp_path / "wh"), "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    day = lambda d, n: make_raw(spark, [{"event_time": f"2024-01-{d:02d}", "user_id": f"u{i}", "platform": "web"} for i in range(n)])
    params = refresh.RunParams(dim_buckets=4)
    refresh.refresh_events(spark, day(1, 100), wh, params)
    try:
        spark.conf.set(setting, "32")   # more than there are buckets
        refresh.refresh_events(spark, day(2, 200), wh, params)
    finally:
        spark.conf.set(setting, before)
    files = [sum(f.endswith(".parquet") for f in names) for _, _, names in os.walk(os.path.join(wh, "dim_users"))]
    assert max(files) == 1 and sum(files) == 4
    dim = refresh.read_table(spark, wh, "dim_users")
    assert dim.count() == 200 and dim.filter(F.col("latest_event_date_utc") == F.lit(dt.date(2024, 1, 2))).count() == 200


def test_periods_are_stored_once(spark, tmp_path, monkeypatch):
    stored = []
    keep = refresh.materialize
    monkeypatch.setattr(refresh, "materialize", lambda df, s, name: stored.append(name) or keep(df, s, name))
    refresh.refresh_all(spark, make_raw(spark, [{"event_time": "2024-01-01", "user_id": "a"}]), str(tmp_path / "wh"), run_quality=False)
    assert stored == ["missing-users", "activity"]

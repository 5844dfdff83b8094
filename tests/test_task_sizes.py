"""The period step is dealt by the size of its input: a task's memory must not
grow with the input (Spark merges shuffled partitions by their bytes, before
each row becomes six)."""
import datetime as dt

import pytest

from tidemark.operators import activity as act
from tidemark.session import input_bytes

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]


@pytest.fixture
def day_base(spark, tmp_path):
    rows = [(d, f"u{u}", "SG" if u % 3 else "ID", "ios", "g", 1 + u % 2, None) for u in range(50) for d in DAYS[u % 7::1 + u % 5]]
    schema = ("activity_date date, user_id string, country string, platform string, utm_source string, "
              "event_count long, miles_sum decimal(38,9)")
    spark.createDataFrame(rows, schema).repartition(1).write.parquet(str(tmp_path / "base"))
    return spark.read.parquet(str(tmp_path / "base"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tasks_of(df):
    return df.rdd.getNumPartitions()


def test_input_bytes(spark, day_base, tmp_path):
    size = sum(f.stat().st_size for f in (tmp_path / "base").glob("*.parquet"))
    assert input_bytes(day_base.filter("event_count > 0").groupBy("user_id").count()) == size
    assert input_bytes(day_base.unionByName(day_base)) == 2 * size
    checkpointed = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")
    assert input_bytes(checkpointed) == 0   # of unknown size


def test_period_tasks_follow_the_input(spark, day_base, monkeypatch):
    want = rows_of(act.user_period_segments(day_base))
    assert tasks_of(act.user_period_segments(day_base)) <= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(act, "INPUT_PER_TASK", input_bytes(day_base) // 40, raising=False)
    assert tasks_of(act.user_period_segments(day_base)) >= 40
    assert rows_of(act.user_period_segments(day_base)) == want


def test_windowed_period_tasks_follow_the_input(spark, day_base, monkeypatch):
    after, as_of = DAYS[-10], DAYS[5]
    state = act.user_state(day_base, as_of)
    want = rows_of(act.classify_since(day_base, after, state=state, as_of=as_of))
    monkeypatch.setattr(act, "INPUT_PER_TASK", input_bytes(day_base) // 40, raising=False)
    assert tasks_of(act.classify_since(day_base, after, state=state, as_of=as_of)) >= 40
    assert rows_of(act.classify_since(day_base, after, state=state, as_of=as_of)) == want

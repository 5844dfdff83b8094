"""File stream -> incremental refresh, two deliveries."""
import datetime as dt

from tidemark.plans.refresh import read_table
from tidemark.session import scratch_path
from tidemark.streaming import stage_files, start_event_ingest

import pytest
from test_ingest import HEADER, HOSTILE, REORDERED, write

from conftest import make_raw


def test_stream_two_deliveries_and_late_rule(spark):
    src, wh, ck = (scratch_path(spark, n) for n in ("s-src", "s-wh", "s-ck"))
    first = make_raw(spark, [{"event_time": "2024-01-10 12:00:00", "user_id": "a", "platform": " iOS"}])
    second = make_raw(spark, [{"event_time": "2024-01-09 12:00:00", "user_id": "old"},
                              {"event_time": "2024-01-10 08:00:00", "user_id": "b"},
                              {"event_time": "2024-01-11 08:00:00", "user_id": "a", "platform": "web"}])
    for i, df in enumerate((first, second)):
        stage_files(spark, df.drop("loaded_at"), src, f"d{i}")
        start_event_ingest(spark, src, wh, checkpoint=ck, loaded_at=dt.datetime(2024, 2, 1)).awaitTermination()
    fct = read_table(spark, wh, "fct_events")
    assert sorted(r.user_id for r in fct.collect()) == ["a", "a", "b"]
    dim = {r.user_id: r.latest_platform for r in read_table(spark, wh, "dim_users").collect()}
    assert dim == {"a": "web", "b": None}


def test_stream_with_period_marts(spark):
    from pyspark.sql import functions as F
    from tidemark.plans.marts import Marts
    from tidemark.sources.adapters import raw_events
    src, wh, ck = (scratch_path(spark, n) for n in ("p-src", "p-wh", "p-ck"))
    raw = raw_events(spark, "/root/testdata/sf0.001")
    cut = F.col("event_time") < F.lit(dt.datetime(2024, 1, 16))
    for i, part in enumerate((raw.filter(cut), raw.filter(~cut))):
        stage_files(spark, part.drop("loaded_at"), src, f"d{i}")
        start_event_ingest(spark, src, wh, checkpoint=ck, loaded_at=dt.datetime(2024, 2, 1),
                           with_periods=True).awaitTermination()
    got = read_table(spark, wh, "fct_growth_accounting")
    want = Marts(raw).growth_accounting
    key = lambda df: sorted(map(tuple, df.select(*sorted(want.columns)).collect()), key=repr)
    assert key(got) == key(want)


def test_stream_reads_files_like_the_batch_loader(spark, tmp_path):
    write(tmp_path, "a.csv", HOSTILE)
    write(tmp_path, "b.csv", REORDERED)
    wh = scratch_path(spark, "h-wh")
    start_event_ingest(spark, str(tmp_path), wh, checkpoint=scratch_path(spark, "h-ck"),
                       loaded_at=dt.datetime(2024, 2, 1)).awaitTermination()
    got = {r.user_id: (r.transaction_category, r.platform, r.utm_source) for r in read_table(spark, wh, "fct_events").collect()}
    assert got == {"u1": ('say "hi" you, ok', "ios", "google"), "u2": ("two\nlines", "web", "bing"), "u3": (None, "android", "bing")}


def test_stream_stops_at_a_file_without_a_column(spark, tmp_path):
    write(tmp_path, "a.csv", [HEADER.replace("gender,", ""), "2024-01-01,1,like,,1,ios,x,SG"])
    q = start_event_ingest(spark, str(tmp_path), scratch_path(spark, "m-wh"), checkpoint=scratch_path(spark, "m-ck"))
    with pytest.raises(Exception, match="gender"):
        q.awaitTermination()

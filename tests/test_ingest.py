"""CSV ingest (G13) and round trip."""
import datetime as dt
import os

import pytest

from tidemark.sources.csv_ingest import IngestError, ingest_events_csv, read_events_csv
from tidemark.session import scratch_path

HEADER = "event_time,user_id,gender,event_type,transaction_category,miles_amount,platform,utm_source,country"


def write(tmp_path, name, lines):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_missing_column_raises(spark, tmp_path):
    p = write(tmp_path, "a.csv", [HEADER.replace(",platform", ""), "2024-01-01,1,F,like,,1,x,SG"])
    with pytest.raises(IngestError, match="platform"):
        read_events_csv(spark, p, dt.datetime(2024, 1, 1))


def test_bad_time_aborts_and_keeps_previous(spark, tmp_path):
    good = write(tmp_path, "g.csv", [HEADER, "2024-01-01 10:00:00,1,F,like,,1.5,ios,g,SG"])
    bad = write(tmp_path, "b.csv", [HEADER, "x,1,F,like,,1.5,ios,g,SG"])
    missing = write(tmp_path, "m.csv", [HEADER, ",1,F,like,,1.5,ios,g,SG"])
    target = scratch_path(spark, "raw")
    assert ingest_events_csv(spark, good, target, dt.datetime(2024, 2, 1)) == 1
    for p in (bad, missing):
        with pytest.raises(IngestError):
            ingest_events_csv(spark, p, target, dt.datetime(2024, 2, 1))
    assert spark.read.parquet(target).count() == 1


def test_lenient_miles_offsets_extra_columns(spark, tmp_path):
    p = write(tmp_path, "c.csv", [HEADER + ",extra",
                                  "2024-01-01T10:00:00+08:00,1,F,like,,x,ios,g,SG,keep",
                                  "2024-01-01 10:00:00.123456,2,F,like,,2.25,ios,g,NA,keep"])
    rows = sorted(read_events_csv(spark, p, dt.datetime(2024, 2, 1)).collect(), key=lambda r: r.user_id)
    assert rows[0].event_time == dt.datetime(2024, 1, 1, 2, 0) and rows[0].miles_amount is None
    assert rows[1].event_time == dt.datetime(2024, 1, 1, 10, 0, 0, 123456) and rows[1].miles_amount == 2.25
    assert rows[1].country == "NA" and rows[0].extra == "keep"
    na = read_events_csv(spark, p, dt.datetime(2024, 2, 1), pandas_na=True)
    assert sorted(r.country for r in na.collect() if r.country) == ["SG"]


def test_fallback_time_layouts(spark, tmp_path):
    p = write(tmp_path, "f.csv", [HEADER, "2024/01/02 03:04:05,1,F,like,,1,ios,g,SG",
                                  "01/02/2024 03:04,2,F,like,,1,ios,g,SG", "01/02/2024,3,F,like,,1,ios,g,SG"])
    got = {r.user_id: r.event_time for r in read_events_csv(spark, p, dt.datetime(2024, 2, 1)).collect()}
    assert got == {"1": dt.datetime(2024, 1, 2, 3, 4, 5), "2": dt.datetime(2024, 1, 2, 3, 4),
                   "3": dt.datetime(2024, 1, 2)}


def test_raw_table_is_day_partitioned_and_pruned(spark, tmp_path):
    from tidemark.operators.staging import stg_events
    p = write(tmp_path, "d.csv", [HEADER, "2024-01-01 10:00:00,1,F,like,,1,ios,g,SG",
                                  "2024-01-05 10:00:00,2,F,like,,1,ios,g,SG"])
    target = scratch_path(spark, "raw-days")
    ingest_events_csv(spark, p, target, dt.datetime(2024, 2, 1))
    raw = spark.read.parquet(target)
    assert "event_date" in raw.columns
    df = stg_events(raw, after=dt.datetime(2024, 1, 3))
    assert [r.user_id for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


HOSTILE = [
    HEADER + ",extra",
    '2024-01-01 10:00:00,u1,F,share,"say ""hi"" you, ok",5,ios,google,US,x',
    '2024-01-02 10:00:00,u2,F,like,"two\nlines",NaN,web,bing,SG,"a,b"',
]
REORDERED = [
    "utm_source,platform,event_time,user_id,gender,event_type,transaction_category,miles_amount,country",
    "bing,android,2024-01-03 10:00:00,u3,M,like,,1.5,DE",
]


def test_quotes_newlines_and_columns_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", HOSTILE)
    write(tmp_path, "b.csv", REORDERED)
    rows = {r.user_id: r for r in read_events_csv(spark, str(tmp_path), dt.datetime(2024, 2, 1)).collect()}
    assert rows["u1"].transaction_category == 'say "hi" you, ok' and rows["u1"].miles_amount == 5
    assert (rows["u1"].platform, rows["u1"].utm_source, rows["u1"].country) == ("ios", "google", "US")
    assert rows["u2"].transaction_category == "two\nlines" and rows["u2"].miles_amount is None and rows["u2"].extra == "a,b"
    assert (rows["u3"].platform, rows["u3"].utm_source, rows["u3"].extra) == ("android", "bing", None)


@pytest.mark.parametrize("line", ["2024-01-01 10:00:00,1,F,like,,1.5,ios,g", "2024-01-01 10:00:00,1,F,like,,1.5,ios,g,SG,more"])
def test_rows_that_do_not_fit_abort_the_load(spark, tmp_path, line):
    p = write(tmp_path, "x.csv", [HEADER, "2024-01-01 10:00:00,1,F,like,,1.5,ios,g,SG", line])
    target = scratch_path(spark, "raw-misfit")
    with pytest.raises(IngestError, match="fit"):
        ingest_events_csv(spark, p, target, dt.datetime(2024, 2, 1))


def test_one_file_without_a_column_aborts_the_load(spark, tmp_path):
    write(tmp_path, "a.csv", HOSTILE)
    write(tmp_path, "b.csv", [HEADER.replace("gender,", ""), "2024-01-01,1,like,,1,ios,x,SG"])
    with pytest.raises(IngestError, match="gender"):
        read_events_csv(spark, str(tmp_path), dt.datetime(2024, 1, 1))


def test_swap_keeps_the_old_table_when_the_new_one_cannot_move_in(spark, tmp_path):
    import os
    from tidemark.plans import sinks
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(OSError):
        sinks.swap_in(spark, str(tmp_path / "absent-1"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "new-2"))
    sinks.swap_in(spark, str(tmp_path / "new-2"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    assert sorted(n for n in os.listdir(tmp_path) if not n.startswith(".")) == ["t"]


def test_tables_see_appended_files(spark, tmp_path):
    from tidemark.sources.tables import read_table
    spark.range(3).write.parquet(str(tmp_path / "region.parquet"))
    assert read_table(spark, str(tmp_path), "region").count() == 3
    spark.range(2).write.mode("append").parquet(str(tmp_path / "region.parquet"))
    assert read_table(spark, str(tmp_path), "region").count() == 5

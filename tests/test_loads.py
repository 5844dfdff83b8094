"""The run ledger and exactly-once loads."""
import contextlib
import datetime as dt
import os
import shutil

import pytest

from test_ingest import HEADER, write
from tidemark.plans.ledger import ClaimRefused, IntervalLedger, LedgerError, RunLedger
from tidemark.sources.csv_ingest import IngestError, headers_of
from tidemark.sources.loads import (RepeatedFile, ledger_path, load_files, load_interval, loaded_files, read_loaded)

T = dt.datetime
STAMP = T(2024, 6, 1)


class Lost(RuntimeError):
    pass


def dies(at):
    def on_step(step):
        if step == at:
            raise Lost(step)
    return on_step


def test_claims_are_exclusive_and_end_once(spark, tmp_path):
    a, b = (RunLedger(spark, str(tmp_path / "l")) for _ in range(2))
    run = a.claim({"x": 1})
    with pytest.raises(ClaimRefused):
        b.claim({"x": 2})
    b.abandon(b.open_run())
    with pytest.raises(LedgerError):
        a.commit(run)                       # it was given up
    again = b.claim({"x": 2})
    assert (again.number, again.attempt) == (1, 2)
    b.commit(again)
    with pytest.raises(LedgerError):
        a.abandon(again)                    # it is committed
    assert [(r.key, r.state) for r in a.runs()] == [("00000001-001", "abandoned"), ("00000001-002", "committed")]
    assert a.claim({}).key == "00000002-001"


def test_two_claims_of_one_number(spark, tmp_path, monkeypatch):
    """Both runs saw the ledger before either claimed: creation decides."""
    a, b = (RunLedger(spark, str(tmp_path / "l")) for _ in range(2))
    before = b.runs()
    a.claim({})
    monkeypatch.setattr(b, "runs", lambda: before)
    with pytest.raises(ClaimRefused, match="just now"):
        b.claim({})


def test_a_claim_that_died_before_it_was_written(spark, tmp_path):
    ledger = IntervalLedger(spark, str(tmp_path))
    (tmp_path / "00000001-001.claimed").write_text("")
    assert ledger.open_run().payload == {} and ledger.watermark() is None
    ledger.abandon(ledger.open_run())
    assert ledger.claim_interval(T(2024, 1, 2)).run.attempt == 2


def test_intervals_have_no_gaps_and_no_overlaps(spark, tmp_path):
    ledger = IntervalLedger(spark, str(tmp_path))
    first = ledger.claim_interval(T(2024, 1, 2))
    assert (first.after, first.upto) == (None, T(2024, 1, 2))
    ledger.commit(first.run)
    for upto, after, why in ((T(2024, 1, 2), None, "already"), (T(2024, 1, 1), None, "already"),
                             (T(2024, 1, 5), T(2024, 1, 3), "gap"), (T(2024, 1, 5), T(2024, 1, 1), "overlaps")):
        with pytest.raises(ClaimRefused, match=why):
            ledger.claim_interval(upto, after)
    second = ledger.claim_interval(T(2024, 1, 5), T(2024, 1, 2))
    assert ledger.run_state("events")["last_run_status"] == "claimed"
    ledger.abandon(second.run)
    ledger.commit(ledger.claim_interval(T(2024, 1, 4)).run)
    assert [(i.after, i.upto) for i in ledger.intervals()] == [(None, T(2024, 1, 2)), (T(2024, 1, 2), T(2024, 1, 4))]
    state = ledger.run_state("events")
    assert state["last_success_event_time"] == T(2024, 1, 4) and state["last_run_status"] == "committed"
    assert state["last_run_started_at"] <= state["last_run_finished_at"] + dt.timedelta(seconds=1)


@pytest.mark.parametrize("step", ["claim", "write", "commit"])
def test_a_run_that_dies_costs_no_row_and_doubles_none(spark, raw, tmp_path, step):
    table = str(tmp_path / "t")
    source = raw([{"event_time": f"2024-01-{d:02d} 00:00:00", "user_id": str(d)} for d in range(1, 11)])
    load_interval(spark, source, table, T(2024, 1, 3))
    with pytest.raises(Lost):
        load_interval(spark, source, table, T(2024, 1, 6), on_step=dies(step))
    assert len(read_loaded(spark, table).collect()) == (6 if step == "commit" else 3)   # all of a run or nothing
    if step != "commit":
        with pytest.raises(ClaimRefused):
            load_interval(spark, source, table, T(2024, 1, 6))
    with pytest.raises(ClaimRefused) if step == "commit" else contextlib.nullcontext():
        load_interval(spark, source, table, T(2024, 1, 6), take_over=True)
    load_interval(spark, source, table, T(2024, 1, 20))
    got = read_loaded(spark, table)
    assert sorted(int(r.user_id) for r in got.collect()) == list(range(1, 11))
    assert got.select("run").distinct().count() == 3
    if step == "write":
        assert not os.path.exists(f"{table}/run=00000002-001")   # what the dead run wrote is gone


def test_an_interval_without_rows(spark, raw, tmp_path):
    source = raw([{"event_time": "2024-01-01", "user_id": "a"}])
    load_interval(spark, source, str(tmp_path), T(2024, 1, 3))
    load_interval(spark, source, str(tmp_path), T(2024, 1, 4))
    assert read_loaded(spark, str(tmp_path)).count() == 1
    with pytest.raises(IngestError):
        read_loaded(spark, str(tmp_path / "none"))


def row(day, user):
    return f"2024-01-{day:02d} 10:00:00,{user},F,like,,1,ios,g,SG"


def test_files_are_loaded_once(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    (inbox / "a").mkdir(parents=True)
    write(inbox / "a", "x.csv", [HEADER, row(1, "u1"), row(2, "u2")])
    assert load_files(spark, f"{inbox}/*", table, STAMP).number == 1
    assert load_files(spark, f"{inbox}/*", table, STAMP) is None
    with pytest.raises(RepeatedFile, match="again"):
        load_files(spark, f"{inbox}/*", table, STAMP, on_repeat="fail")
    shutil.copytree(inbox / "a", inbox / "b")                       # delivered twice
    write(inbox / "b", "y.csv", [HEADER, row(3, "u3")])
    load_files(spark, f"{inbox}/*", table, STAMP)
    got = read_loaded(spark, table)
    assert {r.user_id: os.path.basename(r.source_file) for r in got.collect()} == {"u1": "x.csv", "u2": "x.csv", "u3": "y.csv"}
    assert got.count() == 3
    assert [(f["name"], f["run"]) for f in loaded_files(spark, table)] == [("x.csv", "00000001-001"), ("y.csv", "00000002-001")]
    write(inbox / "a", "x.csv", [HEADER, row(1, "u1"), row(2, "u9"), row(4, "u4")])
    with pytest.raises(RepeatedFile, match="changed"):
        load_files(spark, f"{inbox}/*", table, STAMP)


def test_the_same_file_twice_in_one_delivery(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / "in" / d).mkdir(parents=True)
        write(tmp_path / "in" / d, "x.csv", [HEADER, row(1, "u1")])
    load_files(spark, f"{tmp_path}/in/*", str(tmp_path / "t"), STAMP)
    assert read_loaded(spark, str(tmp_path / "t")).count() == 1


def test_a_bad_file_leaves_the_table_as_it_was(spark, tmp_path):
    table = str(tmp_path / "t")
    write(tmp_path, "x.csv", [HEADER, row(1, "u1")])
    load_files(spark, f"{tmp_path}/*.csv", table, STAMP)
    bad = write(tmp_path, "bad.csv", [HEADER, row(2, "u2"), "soon,u3,F,like,,1,ios,g,SG"])
    with pytest.raises(IngestError):
        load_files(spark, f"{tmp_path}/*.csv", table, STAMP)
    assert [r.user_id for r in read_loaded(spark, table).collect()] == ["u1"]
    os.remove(bad)
    write(tmp_path, "good.csv", [HEADER, row(2, "u2")])
    assert load_files(spark, f"{tmp_path}/*.csv", table, STAMP).key == "00000002-002"
    assert read_loaded(spark, table).count() == 2


def test_headers_are_read_without_a_spark_job(spark, tmp_path):
    files = [write(tmp_path, f"{i}.csv", ["﻿" * (i == 3) + HEADER.replace("gender", '"gender"') + ",e" * (i % 2), "x"]) for i in range(6)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    groups = headers_of(spark, files)
    assert not tracker.getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(len, groups.values())) == [3, 3] and all("gender" in g for g in groups)
    with pytest.raises(IngestError):
        headers_of(spark, [write(tmp_path, "empty.csv", [""])])

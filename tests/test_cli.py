"""End-to-end through the command line: load CSV, precheck, run, test, backfill."""
import json

from tidemark.__main__ import main
from tidemark.plans.refresh import read_table
from tidemark.session import scratch_path
from tidemark.sources.adapters import raw_events
from tidemark.sources.csv_ingest import write_events_csv


def test_cli_all_then_backfill(spark, capsys):
    csv = scratch_path(spark, "cli-csv")
    wh = scratch_path(spark, "cli-wh")
    write_events_csv(raw_events(spark, "/root/testdata/sf0.001").drop("loaded_at"), csv)
    types = "click,error,purchase,signup,view"
    assert main(["all", "--csv", csv, "--warehouse", wh, "--execution-date", "2024-01-10",
                 "--event-types", types]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["loaded_rows"] == 1000
    assert all(f == 0 for _, sev, f in out["checks"] if sev == "error")
    g = read_table(spark, wh, "fct_growth_accounting")
    assert g.agg({"period_start": "max"}).first()[0].isoformat() <= "2024-01-10"
    assert main(["backfill", "--warehouse", wh]) == 0
    g2 = read_table(spark, wh, "fct_growth_accounting")
    assert g2.agg({"period_start": "max"}).first()[0].isoformat() > "2024-01-10"


def test_cli_precheck_gate_fails_without_source_rows(spark):
    import pytest
    from tidemark.operators.quality import DataQualityError
    csv = scratch_path(spark, "cli-csv2")
    wh = scratch_path(spark, "cli-wh2")
    write_events_csv(raw_events(spark, "/root/testdata/sf0.001").drop("loaded_at"), csv)
    assert main(["load", "--csv", csv, "--warehouse", wh]) == 0
    with pytest.raises(DataQualityError, match="source_availability"):
        main(["precheck", "--warehouse", wh, "--execution-date", "2025-06-01"])


def test_cutoff_now_is_the_moment_of_the_call():
    import datetime as dt

    from tidemark.__main__ import cutoff
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    got = dt.datetime.fromisoformat(cutoff("now"))
    assert before <= got <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert cutoff("") is None and cutoff("2024-01-02") == "2024-01-02"

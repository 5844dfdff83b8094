"""Append-only loads that happen exactly once: by time interval, or by file.

A table is a folder with one sub-folder per run (``run=<number>-<attempt>``) and
a ledger. A load claims a run, writes its rows to the run's folder and commits;
readers read the folders of committed runs only. So rows appear when the run is
committed, all at once, and what a run leaves behind that died before is never
read: the next load abandons that run, removes its folder and starts again.

* ``load_interval``: the rows of a source with ``t1 < time <= t2``, where t1 is
  where the last load ended. Rows without a time are in no interval.
* ``load_files``: the CSV files that no load has had. A file is known by its
  name and size: one that is delivered again, in the same place or another, is
  skipped or refused; one that has changed since it was loaded is refused.

``on_step(step)`` is called after the claim, after the rows are written and
after the commit; what it raises stops the load there.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.staging import time_window
from ..plans import sinks
from ..plans.ledger import Interval, IntervalLedger, Run, RunLedger
from ..session import join_path
from .csv_ingest import CORRUPT, IngestError, RAW_DAY_COLUMN, bad_rows, check_counts, list_files, read_event_files

LEDGER = "_ledger"
RUN_COLUMN = "run"


def ledger_path(table: str) -> str:
    return join_path(table, LEDGER)


def run_folder(table: str, run: Run) -> str:
    return join_path(table, f"{RUN_COLUMN}={run.key}")


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all committed runs, with the run that loaded each."""
    folders = [run_folder(table, r) for r in RunLedger(spark, ledger_path(table)).committed()]
    folders = [f for f in folders if sinks.exists(spark, f)]
    if not folders:
        raise IngestError(f"nothing has been loaded into {table}")
    return spark.read.option("basePath", table).option("mergeSchema", True).parquet(*folders)


def give_up(spark: SparkSession, table: str, ledger: RunLedger, run: Run) -> None:
    """Abandon a run that died, and remove what it wrote."""
    ledger.abandon(run)
    sinks.drop_path(spark, run_folder(table, run))


def _no_step(step: str) -> None:
    pass


def _write(rows: DataFrame, table: str, run: Run, ledger: RunLedger, also: tuple = ()) -> dict:
    """Write the run's rows, and note their number and bounds, which are observed
    on the way. Returns all that was observed."""
    obs = Observation("load")
    bounds = [F.max(c).alias(f"max_{c}") for c in ("event_time", "loaded_at")] + [F.min("event_time").alias("min_event_time")]
    # Observed after the exchange: without rows Spark leaves out what lies before it.
    (rows.withColumn(RAW_DAY_COLUMN, F.to_date("event_time")).hint("rebalance", RAW_DAY_COLUMN)
     .observe(obs, F.count(F.lit(1)).alias("rows"), *bounds, *also).drop(CORRUPT)
     .write.partitionBy(RAW_DAY_COLUMN).parquet(run_folder(table, run)))
    found = obs.get
    ledger.note(run, {"rows": found["rows"]} | {k: None if found[k] is None else found[k].isoformat()
                                                for k in ("min_event_time", "max_event_time", "max_loaded_at")})
    return found


def load_interval(spark: SparkSession, source: DataFrame, table: str, upto: dt.datetime, time_col: str = "event_time",
                  after: dt.datetime | None = None, take_over: bool = False,
                  on_step: Callable[[str], None] = _no_step) -> Interval:
    """Load the source's rows up to ``upto`` that earlier loads haven't had.

    With ``take_over`` a run that is still open is given up first (only its
    scheduler knows that it is dead); otherwise it makes the claim fail."""
    ledger = IntervalLedger(spark, ledger_path(table))
    if take_over and (dead := ledger.open_run()) is not None:
        give_up(spark, table, ledger, dead)
    interval = ledger.claim_interval(upto, after)
    on_step("claim")
    _write(time_window(source, time_col, interval.after, upto), table, interval.run, ledger)
    on_step("write")
    ledger.commit(interval.run)
    on_step("commit")
    return interval


def load_bounds(spark: SparkSession, table: str) -> dict:
    """rows, min_event_time, max_event_time and max_loaded_at of everything loaded,
    from what the runs noted: no file of the table is opened."""
    ledger = RunLedger(spark, ledger_path(table))
    facts = [ledger.facts(r) for r in ledger.committed()]
    times = {k: [dt.datetime.fromisoformat(f[k]) for f in facts if f.get(k)] for k in ("min_event_time", "max_event_time", "max_loaded_at")}
    return {"rows": sum(f.get("rows", 0) for f in facts),
            "min_event_time": min(times["min_event_time"], default=None)} | {
        k: max(times[k], default=None) for k in ("max_event_time", "max_loaded_at")}


class RepeatedFile(IngestError):
    pass


def file_facts(spark: SparkSession, files: list[str]) -> list[dict]:
    """Path, name, size and modification time of each file."""
    out = []
    for f in files:
        p, fs = sinks._fs(spark, f)
        st = fs.getFileStatus(p)
        out.append({"path": f, "name": p.getName(), "size": st.getLen(), "modified": st.getModificationTime()})
    return out


def loaded_files(spark: SparkSession, table: str) -> list[dict]:
    """What the committed loads of a table had, with their run."""
    return [f | {"run": r.key} for r in RunLedger(spark, ledger_path(table)).committed() for f in r.payload.get("files", [])]


def new_files(spark: SparkSession, table: str, files: list[str], on_repeat: str = "skip") -> list[dict]:
    """Those of ``files`` that no load of ``table`` has had. The same name and
    size is a repeat (``skip`` or ``fail``), the same path with another size or
    time a change, which always fails."""
    if on_repeat not in ("skip", "fail"):
        raise ValueError(f"on_repeat must be 'skip' or 'fail', got {on_repeat!r}")
    had = loaded_files(spark, table)
    by_path, by_content = {f["path"]: f for f in had}, {(f["name"], f["size"]): f for f in had}
    out = []
    for f in file_facts(spark, files):
        known = by_path.get(f["path"])
        if known is not None and (known["size"], known["modified"]) != (f["size"], f["modified"]):
            raise RepeatedFile(f"{f['path']} has changed since run {known['run']} loaded it")
        first = known or by_content.get((f["name"], f["size"]))
        if first is None:
            by_content[f["name"], f["size"]] = f | {"run": "this one"}
            out.append(f)
        elif on_repeat == "fail":
            raise RepeatedFile(f"{f['path']} is {first['path']} again, which run {first['run']} has loaded")
    return out


def load_files(spark: SparkSession, csv_path: str, table: str, loaded_at: dt.datetime | None = None, pandas_na: bool = False,
               on_repeat: str = "skip", take_over: bool = False, on_step: Callable[[str], None] = _no_step) -> Run | None:
    """Load the CSV files at a path that haven't been loaded; None if there are none.

    The checks are those of ``ingest_events_csv``: a file without a required
    column, a row that doesn't fit or has no readable time stops the load, and
    the table stays as it was."""
    ledger = RunLedger(spark, ledger_path(table))
    if take_over and (dead := ledger.open_run()) is not None:
        give_up(spark, table, ledger, dead)
    files = new_files(spark, table, list_files(spark, csv_path), on_repeat)
    if not files:
        return None
    stamp = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run = ledger.claim({"files": files})
    on_step("claim")
    try:
        rows = read_event_files(spark, [f["path"] for f in files], stamp, pandas_na)
        check_counts(_write(rows, table, run, ledger, tuple(bad_rows()[1:])))
    except Exception:
        give_up(spark, table, ledger, run)
        raise
    on_step("write")
    ledger.commit(run)
    on_step("commit")
    return run


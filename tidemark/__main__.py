"""Command line: the load / precheck / run / test / all / backfill steps.

  python -m tidemark load     --csv events.csv --warehouse W
  python -m tidemark precheck --warehouse W [--execution-date D]
  python -m tidemark run      --warehouse W [--execution-date D] [--full-refresh]
  python -m tidemark test     --warehouse W
  python -m tidemark all      --csv events.csv --warehouse W [...]
  python -m tidemark backfill --warehouse W            (full refresh, no lookbacks)

Every step stops with a non-zero exit status at the first failure.
"""
from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .operators import quality as dq
from .params import RunParams
from .plans import refresh
from .session import build_session, join_path


def _args(argv):
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("step", choices=["load", "precheck", "run", "test", "all", "backfill"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--csv")
    ap.add_argument("--master")
    ap.add_argument("--execution-date", default="", help="inclusive cutoff (UTC); 'now' for the moment of the call")
    ap.add_argument("--late-arrival-lookback-days", type=int, default=1)
    ap.add_argument("--period-lookback-days", type=int, default=62)
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--pandas-na", action="store_true")
    ap.add_argument("--precheck-scope", choices=["all", "window"], default="all",
                    help="duplicate gate over the whole source or only the rows this run reads")
    ap.add_argument("--reconcile", action="store_true", help="compare all grains with stored distinct-user bitmaps (step test)")
    ap.add_argument("--event-types", default=",".join(dq.REFERENCE_EVENT_TYPES))
    return ap.parse_args(argv)


def cutoff(text: str) -> str | None:
    """The cutoff argument; ``now`` is resolved once, for all steps of a run."""
    if text.strip().lower() == "now":
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    return text or None


def main(argv=None) -> int:
    a = _args(argv if argv is not None else sys.argv[1:])
    spark = build_session(a.master)
    params = RunParams(execution_date=cutoff(a.execution_date),
                       late_arrival_lookback_days=a.late_arrival_lookback_days,
                       period_lookback_days=a.period_lookback_days,
                       full_refresh=a.full_refresh or a.step == "backfill")
    raw_path = join_path(a.warehouse, "raw_events")
    event_types = tuple(x for x in a.event_types.split(",") if x)
    out = {}
    if a.step in ("load", "all"):
        if not a.csv:
            raise SystemExit("--csv is required for load")
        from .sources.csv_ingest import ingest_events_csv
        out["loaded_rows"] = ingest_events_csv(spark, a.csv, raw_path, pandas_na=a.pandas_na)
    raw = spark.read.parquet(raw_path) if a.step != "load" else None
    if a.step in ("precheck", "all"):
        since = None
        if a.precheck_scope == "window":
            since = refresh.event_lower_bound(spark, refresh.table_path(a.warehouse, "stg_events"),
                                         "event_time_utc", "event_date_utc", params)
        out["precheck"] = dq.run_checks(refresh.pre_checks(raw, params, since=since))
    if a.step in ("run", "all", "backfill"):
        w = refresh.refresh_events(spark, raw, a.warehouse, params)
        w.update(refresh.refresh_periods(spark, a.warehouse, params, changed_since=w["fct_events"]))
        out["windows"] = {k: (str(v) if v is not None else None) for k, v in w.items()}
    if a.step in ("test", "all"):
        checks = refresh.post_checks(spark, raw, a.warehouse, params, event_types)
        if a.reconcile:
            checks += refresh.cross_grain_checks(spark, a.warehouse)
        out["checks"] = dq.run_checks(checks)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

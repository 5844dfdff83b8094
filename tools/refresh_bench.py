"""Time a full build and an incremental run of the stored warehouse.

Batch 1: events up to 2024-01-20 (late error events withheld); batch 2: all
events. Reports seconds for the full build of batch 1, the incremental run of
batch 2, a full refresh over all events and a no-op incremental run with the
quality suite; checks that incremental fact rows plus ignored late events
account for every event. Usage: python tools/refresh_bench.py [sf_dir]
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog.queries import _batches  # noqa: E402
from tidemark.params import RunParams  # noqa: E402
from tidemark.plans import refresh  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k"})
    spark.sparkContext.setLogLevel("ERROR")
    b1, everything = _batches(spark, sf)
    inc, full = scratch_path(spark, "bench-inc"), scratch_path(spark, "bench-full")
    t = {}
    t0 = time.perf_counter()
    refresh.refresh_all(spark, b1, inc, run_quality=False)
    t["build_batch1"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    r = refresh.refresh_all(spark, everything, inc, RunParams(period_lookback_days=7), run_quality=False)
    t["incremental_batch2"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    refresh.refresh_all(spark, everything, full, run_quality=False)
    t["full_refresh_all"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    checks = refresh.refresh_all(spark, everything, full, RunParams(period_lookback_days=7),
                                 event_types=("click", "error", "purchase", "signup", "view")).checks
    t["incremental_noop_with_checks"] = time.perf_counter() - t0
    n_inc = refresh.read_table(spark, inc, "fct_events").count()
    n_full = refresh.read_table(spark, full, "fct_events").count()
    n_late = refresh.ignored_late_events(spark, everything, inc).count()
    print(json.dumps({"sf": sf, **{k: round(v, 2) for k, v in t.items()},
                      "fct_rows_incremental": n_inc, "fct_rows_full": n_full,
                      "late_events_ignored": n_late, "accounted": n_inc + n_late == n_full,
                      "failed_checks": [c for c in checks if c[1] == "error" and c[2] > 0],
                      "windows": {k: str(v) for k, v in r.windows.items()}}))


if __name__ == "__main__":
    main()

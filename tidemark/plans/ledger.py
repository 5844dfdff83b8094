"""Durable run ledger: what each run of a job claimed, and how that ended.

A ledger is a folder of small files ``<number>-<attempt>.<state>``. A run claims
the next number by creating ``.claimed`` (creation is exclusive, so of two runs
one is refused) with what it is going to do; renaming that file to
``.committed`` or ``.abandoned`` ends the run. Only one rename of a file can
succeed, so a run that was given up can't commit later, and a committed one
can't be given up. A number is open while it is claimed: nobody claims the next
before it is committed, or the same again before it is abandoned. So a run that
died blocks its successors visibly instead of leaving a gap.

(Exclusive creation and atomic renames are what HDFS and local file systems
give; an object store needs a connector with both.)

``IntervalLedger`` hands out the time intervals ``(t1, t2]`` of an incremental
load: each starts where the last committed one ended.
"""
from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from ..session import join_path
from . import sinks

CLAIMED, COMMITTED, ABANDONED = "claimed", "committed", "abandoned"


class LedgerError(RuntimeError):
    pass


class ClaimRefused(LedgerError):
    """Another run holds the number, or the claim leaves a gap or overlaps."""


@dataclass(frozen=True)
class Run:
    number: int
    attempt: int
    state: str
    payload: dict = field(compare=False)
    changed_at: dt.datetime | None = field(default=None, compare=False)

    @property
    def key(self) -> str:
        return f"{self.number:08d}-{self.attempt:03d}"


class RunLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def runs(self) -> list[Run]:
        """All runs in order (one driver listing; a claim that died before it was
        written has an empty payload)."""
        p, fs = sinks._fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name, _, state = st.getPath().getName().partition(".")
            if state in (CLAIMED, COMMITTED, ABANDONED):
                number, attempt = map(int, name.split("-"))
                at = dt.datetime.fromtimestamp(st.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None)
                out.append(Run(number, attempt, state, self._read(fs, st.getPath()), at))
        return sorted(out, key=lambda r: (r.number, r.attempt))

    def _read(self, fs, path) -> dict:
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return {}

    def committed(self) -> list[Run]:
        return [r for r in self.runs() if r.state == COMMITTED]

    def open_run(self) -> Run | None:
        """The run that has claimed a number and neither committed nor abandoned it."""
        return next((r for r in self.runs() if r.state == CLAIMED), None)

    def claim(self, payload: dict) -> Run:
        """Claim the next number for ``payload`` (anything JSON can hold)."""
        runs = self.runs()
        held = next((r for r in runs if r.state == CLAIMED), None)
        if held is not None:
            raise ClaimRefused(f"run {held.key} since {held.changed_at} is open in {self.path}: wait for it or abandon it")
        number = max((r.number for r in runs if r.state == COMMITTED), default=0) + 1
        attempt = max((r.attempt for r in runs if r.number == number), default=0) + 1
        run = Run(number, attempt, CLAIMED, payload | {"started_at": _now().isoformat()})
        p, fs = sinks._fs(self.spark, self._file(run, CLAIMED))
        try:
            stream = fs.create(p, False)
        except (Py4JJavaError, PySparkException) as e:
            raise ClaimRefused(f"run {run.key} was claimed by another run just now") from e
        try:
            stream.write(bytearray(json.dumps(run.payload).encode()))
        finally:
            stream.close()
        return run

    def note(self, run: Run, facts: dict) -> None:
        """Keep what the run found out (anything JSON can hold) beside its claim."""
        p, fs = sinks._fs(self.spark, self._file(run, "facts"))
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(facts).encode()))
        finally:
            stream.close()

    def facts(self, run: Run) -> dict:
        p, fs = sinks._fs(self.spark, self._file(run, "facts"))
        return self._read(fs, p) if fs.exists(p) else {}

    def commit(self, run: Run) -> None:
        self._end(run, COMMITTED)

    def abandon(self, run: Run) -> None:
        self._end(run, ABANDONED)

    def _file(self, run: Run, state: str) -> str:
        return join_path(self.path, f"{run.key}.{state}")

    def _end(self, run: Run, state: str) -> None:
        src, fs = sinks._fs(self.spark, self._file(run, CLAIMED))
        dst, _ = sinks._fs(self.spark, self._file(run, state))
        done = False
        if fs.exists(src):
            try:
                done = fs.rename(src, dst)
            except (Py4JJavaError, PySparkException):
                done = False
        if not done:
            raise LedgerError(f"run {run.key} of {self.path} is no longer open: it can't be {state}")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Interval:
    """``(after, upto]``; ``after`` is None in the first one."""
    run: Run
    after: dt.datetime | None
    upto: dt.datetime


def interval_of(run: Run) -> Interval:
    at = run.payload.get("after")
    return Interval(run, None if at is None else dt.datetime.fromisoformat(at), dt.datetime.fromisoformat(run.payload["upto"]))


class IntervalLedger(RunLedger):
    def intervals(self) -> list[Interval]:
        """The committed intervals: each begins where the one before ends."""
        return [interval_of(r) for r in self.committed()]

    def watermark(self) -> dt.datetime | None:
        """The end of the last committed interval."""
        done = self.intervals()
        return done[-1].upto if done else None

    def claim_interval(self, upto: dt.datetime, after: dt.datetime | None = None) -> Interval:
        """Claim ``(watermark, upto]``. A caller that names ``after`` is refused
        unless that is the watermark."""
        mark = self.watermark()
        if after is not None and after != mark:
            what = "leaves a gap after" if mark is None or after > mark else "overlaps"
            raise ClaimRefused(f"({after}, {upto}] {what} what is loaded up to {mark}")
        if mark is not None and upto <= mark:
            raise ClaimRefused(f"everything up to {mark} is loaded already; {upto} isn't later")
        run = self.claim({"after": None if mark is None else mark.isoformat(), "upto": upto.isoformat()})
        if self.watermark() != mark:
            self.abandon(run)   # another run committed between the look and the claim
            raise ClaimRefused(f"another run has loaded up to {self.watermark()} meanwhile")
        return interval_of(run)

    def run_state(self, job: str) -> dict:
        """The job's row of a run-state table."""
        runs = self.runs()
        last = runs[-1] if runs else None
        return {
            "job_name": job,
            "last_success_event_time": self.watermark(),
            "last_run_started_at": dt.datetime.fromisoformat(last.payload["started_at"]) if last and last.payload else None,
            "last_run_finished_at": last.changed_at if last and last.state != CLAIMED else None,
            "last_run_status": last.state if last else None,
        }

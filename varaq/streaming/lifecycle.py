"""The life of jobs as a stateful stream: legal moves only, deadlines at the boundaries of stages, kept for a time after the end.

Each job has a typed state in RocksDB. An event moves it if the table of moves has a move for its state; others (late, seen
before, after the end, of the wrong order) are dropped. A cancellation ends a waiting job at once and a running one at the next
boundary, where the deadline is judged as well. A completed job whose delivery fails stays completed and has a
warning. A timer in event time tells when an ended job's retention is over; then its state goes, for its files to be deleted.

So the outcome is a function of each job's events in the order of their numbers, however the stream cuts them into batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from varaq.config import SETTINGS
from varaq.functions.rules import STAGE_STATE, TERMINAL

EVENTS = "id string, seq bigint, event string, stage string, at timestamp, error string"
CHANGES = "id string, seq bigint, state string, at timestamp, started_at timestamp, error_summary string, warnings array<string>, expired boolean"
_STATE = "state string, seq bigint, at bigint, started bigint, error string, warnings string"

#: What a job says of its end.
TIMED_OUT, CANCELLED, DELIVERY_FAILED = "processing timeout reached", "cancelled by user", "TELEGRAM_DELIVERY_FAILED"

_WAITING = ("received", "validating", "queued")
_WORKING = ("downloading", "ready", "processing", "extracting", "ocr", "exporting")
#: (state, event) -> state; "" is a job that is not known yet. A stage leads to the state of its name.
MOVES = {
    ("", "received"): "received",
    ("received", "validating"): "validating",
    ("received", "queued"): "queued",
    ("validating", "queued"): "queued",
    ("queued", "started"): "downloading",
    ("downloading", "ready"): "ready",
    ("ready", "processing"): "processing",
    **{(s, "stage"): "" for s in ("ready", "processing", "extracting", "ocr", "exporting")},
    **{(s, "cancel"): "cancelled" for s in _WAITING},
    **{(s, "cancel"): "cancel_requested" for s in _WORKING},
    **{("cancel_requested", e): "cancelled" for e in ("ready", "stage")},
    **{(s, "finished"): "completed" for s in ("processing", "extracting", "ocr", "exporting", "cancel_requested")},
    **{(s, "error"): "failed" for s in (*_WAITING, *_WORKING, "cancel_requested")},
    ("completed", "delivery_failed"): "completed",
}
#: Events before which a worker looks whether to stop.
BOUNDARIES = ("ready", "stage")


@dataclass(frozen=True)
class Job:
    """What is known of a job; times in microseconds."""

    state: str = ""
    seq: int = -1
    at: int = 0
    started: int | None = None
    error: str | None = None
    warnings: tuple[str, ...] = ()


def moved(job: Job, seq: int, event: str, stage: str | None, at: int, error: str | None, timeout_us: int) -> Job:
    """The job after an event, or the same object if the event moves nothing."""
    to = MOVES.get((job.state, event))
    if seq <= job.seq or to is None:
        return job
    if event == "stage" and job.state != "cancel_requested":
        to = STAGE_STATE.get(stage or "", "processing")
    new = replace(job, state=to, seq=seq, at=at)
    if event in BOUNDARIES and job.state != "cancel_requested" and job.started is not None and at >= job.started + timeout_us:
        return replace(new, state="failed", error=TIMED_OUT)
    if to == "cancelled":
        return replace(new, error=CANCELLED)
    if event == "started":
        return replace(new, started=at)
    if event == "error":
        return replace(new, error=error)
    if event == "delivery_failed":
        return job if DELIVERY_FAILED in job.warnings else replace(new, warnings=(*job.warnings, DELIVERY_FAILED))
    return new


class Lifecycle(StatefulProcessor):
    def __init__(self, timeout_seconds: int, retention_hours: int):
        self.timeout_us, self.retention_ms = timeout_seconds * 1_000_000, retention_hours * 3_600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.job = handle, handle.getValueState("job", _STATE)

    def _read(self) -> Job:
        if not self.job.exists():
            return Job()
        state, seq, at, started, error, warnings = self.job.get()
        return Job(state, seq, at, started, error, tuple(warnings.split("\n")) if warnings else ())

    @staticmethod
    def _row(key: tuple, job: Job, expired: bool) -> pd.DataFrame:
        time = lambda us: pd.NaT if us is None else pd.Timestamp(us, unit="us")
        return pd.DataFrame({"id": [key[0]], "seq": [job.seq], "state": [job.state], "at": [time(job.at)], "started_at": [time(job.started)], "error_summary": [job.error], "warnings": [list(job.warnings)], "expired": [expired]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = job = self._read()
        for r in pd.concat(list(rows)).sort_values("seq", kind="stable").itertuples(index=False):
            text = lambda x: None if pd.isna(x) else x
            if not pd.isna(r.at):
                job = moved(job, int(r.seq), r.event, text(r.stage), r.at.value // 1000, text(r.error), self.timeout_us)
        if job is before:
            return
        self.job.update((job.state, job.seq, job.at, job.started, job.error, "\n".join(job.warnings)))
        if job.state in TERMINAL and before.state not in TERMINAL:
            self.handle.registerTimer(job.at // 1000 + self.retention_ms)
        yield self._row(key, job, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        job = self._read()
        self.job.clear()
        if job.state:
            yield self._row(key, job, True)

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, as typed state needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def lifecycle(events: DataFrame, late: str = "0 seconds", timeout_seconds: int = SETTINGS.timeout_seconds, retention_hours: int = SETTINGS.retention_hours) -> DataFrame:
    """A row whenever a batch has moved a job, and one, with `expired`, when an ended job's retention is over.

    events: a stream of EVENTS. Event times should not go back by more than `late`: Spark drops what is older than the watermark.
    """
    use_state_store(events.sparkSession)
    keyed = events.where("id is not null and seq is not null").withWatermark("at", late).groupBy("id")
    return keyed.transformWithStateInPandas(Lifecycle(timeout_seconds, retention_hours), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime")


def replayed(events: Iterable[tuple], timeout_seconds: int = SETTINGS.timeout_seconds) -> dict[str, Job]:
    """The jobs after all events (rows of EVENTS), without Spark: for tests and for a look at one job."""
    jobs: dict[str, Job] = {}
    for i, seq, event, stage, at, error in sorted(events, key=lambda e: (e[0], e[1])):
        us = round((at - datetime(1970, 1, 1)).total_seconds() * 1e6)
        jobs[i] = moved(jobs.get(i, Job()), seq, event, stage, us, error, timeout_seconds * 1_000_000)
    return {i: j for i, j in jobs.items() if j.state}

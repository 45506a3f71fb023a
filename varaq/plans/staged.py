"""Stages whose work is done one after the other: each is written out before the next begins, can be stopped while its
jobs run, and is not done again by a later run over the same input.

A stage writes its relations as Parquet below its own folder and then a marker, which names them, the input (`key`) and
the marker of the stage before. A marker counts if key and predecessor are the same, so that a stage whose input was done
anew is done anew itself. What a run that was killed has left without a marker is overwritten.

While a stage works, a thread asks whether to stop, and cancels the jobs of the stage by their tag; the tasks are
interrupted. So a stop takes effect within seconds, whatever the stage does.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType

from varaq.config import SETTINGS
from varaq.plans import engine
from varaq.plans.engine import Library, Stage
from varaq.sources import files

CANCELLED, TIMED_OUT = "cancelled by user", "processing timeout reached"


class Stopped(engine.Cancelled):
    """The stage that did not end, and why."""

    def __init__(self, stage: str, reason: str):
        super().__init__(f"{reason} (stage {stage})")
        self.stage, self.reason = stage, reason


@dataclass(frozen=True)
class Progress:
    """What the watching thread sees of a stage: its tasks so far."""

    stage: str
    seconds: float
    tasks: int
    tasks_done: int


@dataclass(frozen=True)
class _Marker:
    id: str
    key: str
    before: str
    relations: tuple[str, ...]

    def text(self) -> str:
        return json.dumps({"id": self.id, "key": self.key, "before": self.before, "relations": self.relations})


def _marker(spark: SparkSession, place: str) -> _Marker | None:
    text = files.read_text(spark, f"{place}/_DONE")
    if text is None:
        return None
    try:
        m = json.loads(text)
        return _Marker(m["id"], m["key"], m["before"], tuple(m["relations"]))
    except (ValueError, KeyError, TypeError):
        return None


def _tasks(spark: SparkSession, jobs: list[int]) -> tuple[int, int]:
    """Tasks, and those done, of jobs that Spark still remembers."""
    tracker, n, done = spark.sparkContext.statusTracker(), 0, 0
    for j in jobs:
        info = tracker.getJobInfo(j)
        for s in info.stageIds if info else []:
            stage = tracker.getStageInfo(s)
            if stage:
                n, done = n + stage.numTasks, done + stage.numCompletedTasks
    return n, done


class _Watch:
    """Runs jobs under a tag of their own and cancels them when `why` gives a reason."""

    def __init__(self, spark: SparkSession, name: str, why: Callable[[], str | None], every: float, watching: Callable[[Progress], None] | None):
        self.sc, self.spark, self.name, self.why, self.every, self.watching = spark.sparkContext, spark, name, why, every, watching
        self.tag, self.reason, self.error = f"varaq-{name}-{uuid.uuid4().hex}", None, None
        self._over = threading.Event()

    def __enter__(self) -> _Watch:
        self.sc.addJobTag(self.tag)
        self.sc.setInterruptOnCancel(True)
        self.sc.setJobGroup(self.tag, f"stage {self.name}", interruptOnCancel=True)
        self._began, self._thread = time.monotonic(), threading.Thread(target=self._look, daemon=True)
        self._thread.start()
        return self

    def _look(self) -> None:
        while not self._over.wait(self.every):
            try:
                self.reason = self.reason or self.why()
                if self.watching is not None and not self.reason:
                    jobs = self.sc.statusTracker().getJobIdsForGroup(self.tag)
                    self.watching(Progress(self.name, time.monotonic() - self._began, *_tasks(self.spark, list(jobs))))
            except Exception as e:  # the question itself failed; the run must not go on unasked
                self.error, self.reason = e, self.reason or repr(e)
            if self.reason:
                self.sc.cancelJobsWithTag(self.tag)  # again and again, as further jobs of the stage may start

    def __exit__(self, kind, error, trace) -> bool:
        self._over.set()
        self._thread.join()
        self.sc.removeJobTag(self.tag)
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            self.sc.setLocalProperty(name, None)
        if self.error is not None:
            raise self.error
        if error is not None and self.reason:
            raise Stopped(self.name, self.reason) from error
        return False


def _writable(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: df[f.name].cast("string") for f in df.schema if isinstance(f.dataType, NullType)})


def run(
    lib: Library,
    folder: str,
    key: str,
    stages: tuple[tuple[str, Stage], ...] = engine.STAGES,
    progress: Callable[[str], None] | None = None,
    cancelled: Callable[[], bool] | None = None,
    timeout_seconds: float | None = SETTINGS.timeout_seconds,
    every: float = 0.2,
    watching: Callable[[Progress], None] | None = None,
) -> Library:
    """Add every stage's relations, read from what the stages have written below `folder`.

    key: what tells this run's input from another's (files.fingerprint() of its folders, say). progress: is told each stage
    that begins; a stage that an earlier run has finished is not told. cancelled: is asked before each stage and while it
    works. The time limit holds for the whole run.
    """
    spark = lib.requests.sparkSession
    limit = None if timeout_seconds is None else time.monotonic() + timeout_seconds

    def why() -> str | None:
        if cancelled is not None and cancelled():
            return CANCELLED
        return TIMED_OUT if limit is not None and time.monotonic() >= limit else None

    before = ""
    for k, (name, stage) in enumerate(stages):
        place = f"{folder.rstrip('/')}/{k:02d}-{name}"
        if reason := why():
            raise Stopped(name, reason)
        done = _marker(spark, place)
        if done is None or (done.key, done.before) != (key, before):
            if progress is not None:
                progress(name)
            files.delete(spark, f"{place}/_DONE")
            with _Watch(spark, name, why, every, watching) as watch:
                made = stage(lib)
                for relation, df in made.items():
                    if watch.reason:
                        raise Stopped(name, watch.reason)
                    _writable(df).write.mode("overwrite").parquet(f"{place}/{relation}", compression="zstd")
            for df in made.values():
                if df.is_cached:
                    df.unpersist()
            while lib.held:
                lib.held.pop().unpersist()
            done = _Marker(uuid.uuid4().hex, key, before, tuple(made))
            files.write_text(spark, f"{place}/_DONE", done.text())
        lib.relations |= {r: spark.read.parquet(f"{place}/{r}") for r in done.relations}
        before = done.id
    return lib

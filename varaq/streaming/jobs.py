"""The job table as a stream of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from varaq.config import SETTINGS
from varaq.functions.rules import RUNNING, TERMINAL

EVENTS = "id string, seq bigint, state string, at timestamp"
_OUT = "id string, state string, since timestamp, changes bigint"


def job_events(spark: SparkSession, folder: str, files_per_batch: int = SETTINGS.queue_capacity) -> DataFrame:
    """Events from files as they arrive; files_per_batch bounds what one batch admits."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _advance(limit_ms: int):
    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            name, seq, since, changes = state.get
            state.remove()
            yield pd.DataFrame({"id": [key[0]], "state": ["failed"], "since": [pd.Timestamp(since, unit="us")], "changes": [changes + 1]})
            return
        name, last, since, changes = state.get if state.exists else ("", -1, 0, 0)
        moved = False
        for r in pd.concat(list(batches)).sort_values("seq", kind="stable").itertuples(index=False):
            if r.seq <= last or name in TERMINAL:
                continue  # late, seen before, or after the end
            name, last, since, changes, moved = r.state, int(r.seq), int(r.at.value // 1000), changes + 1, True
        state.update((name, last, since, changes))
        if name in RUNNING:
            state.setTimeoutDuration(limit_ms)
        if moved:
            yield pd.DataFrame({"id": [key[0]], "state": [name], "since": [pd.Timestamp(since, unit="us")], "changes": [changes]})

    return advance


def lifecycle(events: DataFrame, timeout_seconds: int = SETTINGS.timeout_seconds) -> DataFrame:
    """The state of each job whenever it changes. A finished job stays as it is; a running one that says nothing for
    longer than the timeout has failed."""
    return events.groupBy("id").applyInPandasWithState(
        _advance(timeout_seconds * 1000), _OUT, "state string, seq bigint, since bigint, changes bigint", "update", GroupStateTimeout.ProcessingTimeTimeout
    )


def arrivals_per_window(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events of each state in each window of time; later ones than the watermark allows are dropped."""
    return events.withWatermark("at", late).groupBy(F.window("at", window), "state").agg(F.count("*").alias("n")).select("window.start", "window.end", "state", "n")

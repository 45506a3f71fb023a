"""Status edits as a stream: of a job's progress reports, the first and then each that comes some seconds after the last shown.

Of a job only the time of the report last shown is kept, and for a limited time. Reports that come in the order of time give
what operators.jobs.status_edits() gives for all of them at once; one that comes later than a newer one was shown is not shown.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from varaq.config import SETTINGS
from varaq.streaming.lifecycle import use_state_store

#: How long a job that says nothing is remembered.
KEPT_MS = SETTINGS.retention_hours * 3_600_000


class Throttle(StatefulProcessor):
    def __init__(self, seconds: int, kept_ms: int):
        self.wait, self.kept_ms = seconds * 1_000_000, kept_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at bigint", self.kept_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        shown = []
        for at in sorted(t for pdf in rows for t in pdf["at"].dropna()):
            us = at.value // 1000
            if last is None or us >= last + self.wait:
                last = us
                shown.append(at)
        if shown:
            self.last.update((last,))
            yield pd.DataFrame({"id": [key[0]] * len(shown), "at": shown})

    def close(self) -> None:
        pass


def status_edits(progress: DataFrame, seconds: int = SETTINGS.status_seconds, kept_ms: int = KEPT_MS) -> DataFrame:
    """id, at of the reports that are shown, of a stream of reports (id string, at timestamp)."""
    use_state_store(progress.sparkSession)
    return progress.groupBy("id").transformWithStateInPandas(Throttle(seconds, kept_ms), outputStructType="id string, at timestamp", outputMode="Append", timeMode="ProcessingTime")

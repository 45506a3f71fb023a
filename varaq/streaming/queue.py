"""The bounded queue as a stream: what is admitted, what starts, what is turned away.

A queue has `capacity` places to wait and runs `concurrency` jobs at once. A submission starts if a worker is free, waits if a
place is, and is rejected otherwise. When a job ends, the one that has waited longest starts; a waiting job that was
cancelled keeps its place until its turn and is passed over then. State is the ids that wait and run, so it is bounded by the
two limits, however long the stream is. Each queue is a key of its own; its events count in the order of their numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from varaq.config import SETTINGS
from varaq.streaming.lifecycle import use_state_store

#: event: submit, cancel or end.
EVENTS = "queue string, seq bigint, event string, id string"
#: what: started, queued (with its position), rejected, skipped.
DECISIONS = "queue string, seq bigint, id string, what string, position int"
FULL = "queue is full"


@dataclass
class Places:
    """Waiting ids in order, running ids, and the waiting ones that were cancelled."""

    waiting: list[str] = field(default_factory=list)
    running: list[str] = field(default_factory=list)
    cancelled: list[str] = field(default_factory=list)
    seq: int = -1

    def take(self, seq: int, event: str, job: str, capacity: int, concurrency: int) -> list[tuple[str, str, int | None]]:
        """(id, what, position) that an event leads to; an event seen before leads to nothing."""
        if seq <= self.seq:
            return []
        self.seq = seq
        out: list[tuple[str, str, int | None]] = []
        if event == "submit" and job not in self.waiting and job not in self.running:
            if len(self.running) < concurrency:
                self.running.append(job)
                out.append((job, "started", None))
            elif len(self.waiting) < capacity:
                self.waiting.append(job)
                out.append((job, "queued", len(self.waiting)))
            else:
                out.append((job, "rejected", None))
        elif event == "cancel" and job in self.waiting and job not in self.cancelled:
            self.cancelled.append(job)
        elif event == "end" and job in self.running:
            self.running.remove(job)
            while self.waiting and len(self.running) < concurrency:
                first = self.waiting.pop(0)
                if first in self.cancelled:
                    self.cancelled.remove(first)
                    out.append((first, "skipped", None))
                else:
                    self.running.append(first)
                    out.append((first, "started", None))
        return out


class Queue(StatefulProcessor):
    def __init__(self, capacity: int, concurrency: int):
        self.capacity, self.concurrency = capacity, concurrency

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.places = handle.getValueState("places", "waiting array<string>, running array<string>, cancelled array<string>, seq bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        places = Places()
        if self.places.exists():
            waiting, running, cancelled, seq = self.places.get()
            places = Places(list(waiting), list(running), list(cancelled), seq)
        out = []
        for r in pd.concat(list(rows)).sort_values("seq", kind="stable").itertuples(index=False):
            out += [(key[0], int(r.seq), *x) for x in places.take(int(r.seq), r.event, r.id, self.capacity, self.concurrency)]
        self.places.update((places.waiting, places.running, places.cancelled, places.seq))
        if out:
            made = pd.DataFrame(out, columns=["queue", "seq", "id", "what", "position"])
            yield made.assign(position=made["position"].astype("Int32"))

    def close(self) -> None:
        pass


def decisions(events: DataFrame, capacity: int = SETTINGS.queue_capacity, concurrency: int = 1) -> DataFrame:
    """What becomes of the submissions of a stream of EVENTS."""
    use_state_store(events.sparkSession)
    keyed = events.where("queue is not null and seq is not null and id is not null").groupBy("queue")
    return keyed.transformWithStateInPandas(Queue(capacity, concurrency), outputStructType=DECISIONS, outputMode="Append", timeMode="None")

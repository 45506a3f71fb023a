"""The job table as it is kept: a snapshot of all jobs and the changes of the batches since, so that reading it does not
fold the history again.

A batch is folded to one row a job, in which each column has its latest value and the number of the event that set it. Such
rows can be merged in any order and any number of times with the same result, so late events, repeated events and
repeated batches do no harm. A batch writes its rows as one Parquet folder (a delta) and then names it in the table's
manifest, whose replacement is the commit. Deltas are merged into a new snapshot when there are MOST_DELTAS of them or
more; so a read takes a row for each job and delta at most. Folders of earlier versions go when the next snapshot is made:
a reader has until then.

One writer at a time: the stream's query, or whoever calls apply(). A crash before the manifest leaves a folder that nothing
names; sweep() removes those.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varaq.sources import files

MOST_DELTAS = 8


@dataclass
class Manifest:
    """version counts commits; batches has, for each source, the last batch that is in; retired, what may go."""

    version: int = 0
    snapshot: str | None = None
    deltas: list[str] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    retired: list[str] = field(default_factory=list)


def manifest(spark: SparkSession, folder: str) -> Manifest:
    text = files.read_text(spark, f"{folder}/_MANIFEST")
    return Manifest() if text is None else Manifest(**json.loads(text))


def _set_by(c: str) -> str:
    return f"{c}__by"


def _columns(df: DataFrame) -> list[str]:
    """The job columns of events or folded rows."""
    return [c for c in df.columns if c not in ("id", "seq") and not c.endswith("__by")]


def folded(events: DataFrame) -> DataFrame:
    """One row a job: each column's latest value that is not null, and the event that set it (<column>__by)."""
    out: list[Column] = []
    for c in _columns(events):
        by = F.when(F.col(c).isNotNull(), F.col("seq").cast("bigint"))
        out += [F.max_by(c, by).alias(c), F.max(by).alias(_set_by(c))]
    return events.where("id is not null").groupBy("id").agg(*out)


def merged(rows: DataFrame) -> DataFrame:
    """Folded rows of several batches as one a job."""
    out: list[Column] = []
    for c in _columns(rows):
        out += [F.max_by(c, _set_by(c)).alias(c), F.max(_set_by(c)).alias(_set_by(c))]
    return rows.groupBy("id").agg(*out)


def _rows(spark: SparkSession, folder: str, m: Manifest) -> DataFrame | None:
    parts = [spark.read.parquet(f"{folder}/{p}") for p in ([m.snapshot] if m.snapshot else []) + m.deltas]
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The jobs, one row an id."""
    rows = _rows(spark, folder, manifest(spark, folder))
    if rows is None:
        raise FileNotFoundError(f"no job table at {folder}")
    return merged(rows).select("id", *_columns(rows))


def _commit(spark: SparkSession, folder: str, m: Manifest) -> None:
    m.version += 1
    files.write_text(spark, f"{folder}/_MANIFEST", json.dumps(asdict(m)))


def apply(events: DataFrame, folder: str, batch: int, source: str = "stream", most_deltas: int = MOST_DELTAS) -> bool:
    """Fold a batch of events (id, seq and the columns that changed) into the table; False if it is in already."""
    spark = events.sparkSession
    m = manifest(spark, folder)
    if batch <= m.batches.get(source, -1):
        return False
    name = f"delta-{uuid.uuid4().hex}"
    folded(events).write.parquet(f"{folder}/{name}")
    m.deltas.append(name)
    m.batches[source] = batch
    _commit(spark, folder, m)
    if len(m.deltas) >= most_deltas:
        compact(spark, folder)
    return True


def compact(spark: SparkSession, folder: str) -> None:
    """Merge the deltas into a new snapshot; what the snapshot before this one was made of goes."""
    m = manifest(spark, folder)
    if not m.deltas:
        return
    name = f"snapshot-{uuid.uuid4().hex}"
    merged(_rows(spark, folder, m)).write.parquet(f"{folder}/{name}")
    gone, m.retired = m.retired, ([m.snapshot] if m.snapshot else []) + m.deltas
    m.snapshot, m.deltas = name, []
    _commit(spark, folder, m)
    for p in gone:
        files.delete(spark, f"{folder}/{p}")


def sweep(spark: SparkSession, folder: str) -> int:
    """Remove folders that the manifest does not name (of writes that were cut off); how many."""
    m = manifest(spark, folder)
    kept = {m.snapshot, *m.deltas, *m.retired}
    gone = [n for n in files.names(spark, folder) if n.startswith(("delta-", "snapshot-")) and n not in kept]
    for n in gone:
        files.delete(spark, f"{folder}/{n}")
    return len(gone)


def keep(events: DataFrame, folder: str, checkpoint: str, source: str = "stream", most_deltas: int = MOST_DELTAS):
    """A writer that keeps the table by a stream of events, to be started: keep(...).start()."""
    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: apply(df, folder, n, source, most_deltas))

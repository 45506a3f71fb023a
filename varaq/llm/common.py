"""Helpers that several training-data operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word separators of the contracts: space, tab, \n, \v, \f, \r. bytes.split() uses the same set.
WORD_CLASS = r"[^\x20\x09-\x0D]+"

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    The setting is read from the session. Where it is unset, a local session (tests) takes a folder of this machine;
    on a cluster that is an error, as executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        base = "file://" + tempfile.gettempdir() + "/varaq-checkpoints"
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, what)
    df.write.parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._varaq_path = path  # for discard()
    return out


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame) -> None:
    """Delete what materialise() wrote. Only for frames that no returned plan still reads."""
    path = getattr(df, "_varaq_path", None)
    if path:
        delete(df.sparkSession, path)


#: Folders that materialise() has written inside the open scratch() blocks.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """What materialise() writes inside goes when the block ends: for callers that write a result out in it. Outside of
    one, a returned plan still reads those folders; they stay in spark.checkpoint.dir for its owner to clear."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete(spark, path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


#: Characters of text that a worker handles at once, unless one text alone is longer.
CHUNK = 500_000


def chunks(batch: pa.RecordBatch, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of about `limit` characters of the column text; Arrow's spare memory goes back after each batch."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield batch.slice(a, b - a)
        a = b
    pa.default_memory_pool().release_unused()


#: Rows of an Arrow batch, at most: texts are long, and each batch is held by Spark and by its Python worker.
BATCH_ROWS = 2000


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, with the session's Arrow batches bounded (a smaller bound of the session's own stays)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


class WordHasher(dict):
    """word (bytes) -> 64-bit hash, remembered up to a bound."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        h = xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = h
        return h


_HASHER = WordHasher()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_HASHER) >= WordHasher.LIMIT:
        _HASHER.clear()  # rare words have filled it; the frequent ones come back at once
    return np.fromiter(map(_HASHER.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` neighbours of h (len(h) - width + 1 values)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    return mix64(out)

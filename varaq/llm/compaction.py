"""Sharding by size-tiered compaction (operator 7).

A shard set is a folder with immutable Parquet files, grouped into runs, and numbered manifests. Arrivals are written as
small runs and registered. Runs fall into tiers by size; FAN_IN runs of a tier are merged into one run of target-sized
files, which falls into a higher tier, until runs of finished shards are left. Every change is committed by renaming a
finished manifest to the next version's name, which fails if that version exists: readers see a whole version or the
one before, and a writer that lost the race takes up the new version, keeping its merge if the merged runs are still
there. The rename is exclusive on HDFS; a local file system checks and renames in two steps, and object stores promise
neither, so there one writer at a time must hold the set.

The manifest carries the schema. An arrival's new columns are added by name (null in the rows before), numeric columns
widen, and every file is read with the manifest's schema, so no merge loses a column.

Nothing is deleted by a commit: every version stays readable until expire() drops the older ones, and with them files
that no version left names. Files that no version ever named (a crashed writer's) go once they are ORPHAN_SECONDS old.

Rows are never dropped or changed; a merge reads its runs' files and writes them again without a shuffle. Sizes are
bytes of the written files. Defined results: an empty arrival makes no run; null columns, very long texts and repeated
rows are kept as they are; a version without runs reads as an empty table of its schema. Names are compared as Spark
compares them: columns that differ by case alone, or whose types cannot be widened, are refused (ValueError) before
anything is written.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varaq.llm.common import shared_dir, table

#: Bytes of a finished shard, and of the smallest tier's runs; runs of a tier that are merged; tiers grow by FAN_IN.
TARGET_BYTES = 128 << 20
SMALLEST_BYTES = 1 << 20
FAN_IN = 4
#: Share of the target that the shards of a finished run have on average.
FINISHED = 0.75
#: Merges that run side by side.
PARALLEL = 4
#: Age from which a file that no version names is a crashed writer's.
ORPHAN_SECONDS = 24 * 3600

_WIDER = {(T.IntegerType, T.LongType), (T.ShortType, T.IntegerType), (T.ShortType, T.LongType), (T.ByteType, T.ShortType), (T.ByteType, T.IntegerType), (T.ByteType, T.LongType), (T.FloatType, T.DoubleType), (T.IntegerType, T.DoubleType)}


class CommitConflict(RuntimeError):
    """Another writer has committed the version first."""


@dataclass(frozen=True)
class Run:
    """files: paths below the set's folder."""

    name: str
    bytes: int
    files: tuple[str, ...]
    sizes: tuple[int, ...]
    counts: tuple[int, ...]

    @property
    def rows(self) -> int:
        return sum(self.counts)


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    runs: tuple[Run, ...]


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of old, then those that only new has; all may be null."""
    have = {f.name.lower(): f for f in old}
    if len(have) < len(old) or len({f.name.lower() for f in new}) < len(new):
        raise ValueError("columns that differ by case alone")
    out = dict(have)
    for f in new:
        was = have.get(f.name.lower())
        if was is None:
            out[f.name.lower()] = f
        elif was.name != f.name:
            raise ValueError(f"columns that differ by case alone: {was.name}, {f.name}")
        elif was.dataType != f.dataType:
            a, b = type(was.dataType), type(f.dataType)
            if (a, b) in _WIDER:
                out[f.name.lower()] = f
            elif (b, a) not in _WIDER:
                raise ValueError(f"column {f.name}: {was.dataType.simpleString()} and {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in out.values()])


class ShardSet:
    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, smallest_bytes: int = SMALLEST_BYTES, fan_in: int = FAN_IN):
        self.spark, self.path = spark, path.rstrip("/")
        self.target, self.smallest, self.fan_in = target_bytes, smallest_bytes, fan_in
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)
        self.fs.mkdirs(self._path("manifests"))

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    # manifests

    def versions(self) -> list[int]:
        names = (f.getPath().getName() for f in self.fs.listStatus(self._path("manifests")))
        return sorted(int(n[1:-5]) for n in names if n[0] == "v" and n.endswith(".json"))

    def version(self) -> int:
        return max(self.versions(), default=0)

    def at(self, version: int | None = None) -> Version:
        """What a version (the newest, unless given) holds."""
        version = self.version() if version is None else version
        if version == 0:
            return Version(0, T.StructType([]), ())
        stream = self.fs.open(self._path(f"manifests/v{version:08d}.json"))
        try:
            told = json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        runs = (Run(r["name"], r["bytes"], tuple(r["files"]), tuple(r["sizes"]), tuple(r["counts"])) for r in told["runs"])
        return Version(version, T.StructType.fromJson(told["schema"]), tuple(runs))

    def runs(self, version: int | None = None) -> list[Run]:
        return list(self.at(version).runs)

    def commit(self, base: int, schema: T.StructType, runs: Iterable[Run]) -> int:
        """Make runs the version after base; CommitConflict if that version is there already."""
        new = base + 1
        draft = self._path(f"manifests/draft-{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(json.dumps({"version": new, "schema": schema.jsonValue(), "runs": [asdict(r) for r in runs]}).encode()))
        out.close()
        args = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        args[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf).rename(draft, self._path(f"manifests/v{new:08d}.json"), args)
        except Exception as e:
            if self.version() >= new:
                self.fs.delete(draft, False)
                raise CommitConflict(f"version {new} exists") from e
            raise
        return new

    # runs

    def _written(self, folder: str, schema: T.StructType) -> list[tuple[str, int, int]]:
        """File, bytes and rows of what a finished write has left in a run's folder; files without rows are left out."""
        stats = self.fs.listStatus(self._path(folder))
        sizes = {s.getPath().getName(): s.getLen() for s in stats if s.getPath().getName().endswith(".parquet")}
        if not sizes:
            return []
        files = [f"{self.path}/{folder}/{f}" for f in sizes]
        counted = self.spark.read.schema(schema).parquet(*files).groupBy(F.substring_index("_metadata.file_path", "/", -1).alias("f")).count()
        rows = {r["f"]: r["count"] for r in counted.collect()}  # a row for each file of one run
        return [(f"{folder}/{f}", sizes[f], rows[f]) for f in sorted(sizes) if rows.get(f)]

    @staticmethod
    def _run(name: str, files: list[tuple[str, int, int]]) -> Run:
        return Run(name, sum(b for _, b, _ in files), *(tuple(x) for x in zip(*files, strict=True)))

    def append(self, rows: DataFrame, each_file: bool = False) -> int:
        """Write an arrival and commit it as a run, or, with each_file, each file that its tasks write as a run of its
        own, all in one version."""
        base = self.at()
        merged_schema(base.schema, rows.schema)  # refused before anything is written
        name = f"run-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        files = self._written(name, rows.schema)
        if not files:
            self.fs.delete(self._path(name), True)
            return base.number
        made = [self._run(f[0], [f]) for f in files] if each_file else [self._run(name, files)]
        while True:
            base = self.at()
            try:
                return self.commit(base.number, merged_schema(base.schema, rows.schema), [*base.runs, *made])
            except CommitConflict:
                continue

    def tier(self, run: Run) -> int:
        return 0 if run.bytes <= self.smallest else math.ceil(math.log(run.bytes / self.smallest, self.fan_in) - 1e-9)

    def finished(self, run: Run) -> bool:
        return run.bytes >= FINISHED * self.target * len(run.files)

    def groups(self, runs: Iterable[Run]) -> list[list[Run]]:
        """The runs to merge now: of the lowest tier that is full, fan_in unfinished runs each, of like size."""
        tiers: dict[int, list[Run]] = {}
        for r in runs:
            if not self.finished(r):
                tiers.setdefault(self.tier(r), []).append(r)
        for k in sorted(tiers):
            full = sorted(tiers[k], key=lambda r: (r.bytes, r.name))
            if len(full) >= self.fan_in:
                return [full[a : a + self.fan_in] for a in range(0, len(full) - self.fan_in + 1, self.fan_in)]
        return []

    def _merge(self, chosen: list[Run], schema: T.StructType) -> Run:
        files = max(1, round(sum(r.bytes for r in chosen) / self.target))
        name = f"run-{uuid.uuid4().hex}"
        self._frame(chosen, schema).coalesce(files).write.parquet(f"{self.path}/{name}")  # whole small files side by side, no shuffle
        return self._run(name, self._written(name, schema))

    def compact(self, keep: int | None = None) -> int:
        """Merge until no tier is full; each round of merges is a version. With keep, versions older than the newest
        `keep` expire after each commit, for sets that nobody reads meanwhile."""
        base = self.at()
        while True:
            chosen = self.groups(base.runs)
            if not chosen:
                return base.number
            with ThreadPoolExecutor(PARALLEL) as pool:
                made = list(zip(chosen, pool.map(lambda g, s=base.schema: self._merge(g, s), chosen), strict=True))
            while made:
                gone = {r.name for g, _ in made for r in g}
                try:
                    self.commit(base.number, base.schema, [*(r for r in base.runs if r.name not in gone), *(m for _, m in made)])
                    break
                except CommitConflict:
                    base = self.at()
                    names = {r.name for r in base.runs}
                    for g, m in made:
                        if not {r.name for r in g} <= names:  # the other writer has merged these itself
                            self.fs.delete(self._path(m.name), True)
                    made = [(g, m) for g, m in made if {r.name for r in g} <= names]
            base = self.at()
            if keep is not None:
                self.expire(keep)

    def expire(self, keep: int, orphan_seconds: float = ORPHAN_SECONDS) -> int:
        """Drop all but the newest `keep` versions and the files that only those named, and files that no version
        named and that are orphan_seconds old. The number of files deleted."""
        versions = self.versions()
        old, left = versions[: max(0, len(versions) - max(keep, 1))], versions[max(0, len(versions) - max(keep, 1)) :]
        named = {f for v in left for r in self.at(v).runs for f in r.files}
        dropped = {f for v in old for r in self.at(v).runs for f in r.files} - named
        for v in old:
            self.fs.delete(self._path(f"manifests/v{v:08d}.json"), False)
        before = (time.time() - orphan_seconds) * 1000
        for s in self.fs.listStatus(self._path("manifests")):
            if s.getPath().getName().startswith("draft-") and s.getModificationTime() < before:
                self.fs.delete(s.getPath(), False)
        n = 0
        for folder in self.fs.listStatus(self._path("")):
            name = folder.getPath().getName()
            if not name.startswith("run-"):
                continue
            stays = 0
            for s in self.fs.listStatus(folder.getPath()):
                file = f"{name}/{s.getPath().getName()}"
                if not file.endswith(".parquet"):
                    stays += s.isDirectory() and s.getModificationTime() >= before  # a write that goes on
                elif file in dropped or (file not in named and s.getModificationTime() < before):
                    self.fs.delete(s.getPath(), False)
                    n += 1
                else:
                    stays += 1
            if not stays and (folder.getModificationTime() < before or any(f.startswith(f"{name}/") for f in dropped)):
                self.fs.delete(folder.getPath(), True)
        return n

    # reading

    def _frame(self, runs: Iterable[Run], schema: T.StructType) -> DataFrame:
        files = [f"{self.path}/{f}" for r in runs for f in r.files]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest, unless given)."""
        at = self.at(version)
        return self._frame(at.runs, at.schema)

    def shards(self, version: int | None = None) -> list[tuple[str, int, int, int]]:
        """File, bytes, rows and tier of each shard of a version, the largest tiers first."""
        runs = sorted(self.at(version).runs, key=lambda r: (-self.tier(r), r.name))
        return [(f, b, n, self.tier(r)) for r in runs for f, b, n in zip(r.files, r.sizes, r.counts, strict=True)]


#: Arrivals at least, where the table has fewer splits; shards whose names are broadcast, at most.
ARRIVALS, BROADCAST_SHARDS = 8, 100_000


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """Documents arrive as the small files that their splits give, and are compacted; the rows of the committed version.

    All columns of documents but the text, of which its code points and digest show that it is whole; listed: the row's
    file is a shard of the committed manifest with as many rows as that says.
    """
    docs = table(spark, sf_dir, "documents")
    if docs.rdd.getNumPartitions() < ARRIVALS:
        docs = docs.repartition(ARRIVALS)
    shards = ShardSet(spark, shared_dir(spark, "shards"))
    shards.append(docs, each_file=True)
    version = shards.compact(keep=1)  # nobody else reads this set
    rows = shards.read(version) if version else docs.limit(0)
    listed = [(f.rsplit("/", 1)[1], n) for f, _, n, _ in shards.shards(version)]
    known = spark.createDataFrame(listed, "_file string, _rows bigint")
    file = F.substring_index(F.col("_metadata.file_path"), "/", -1) if version else F.lit("")
    shown = rows.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("bigint").alias("text_chars"), F.sha2("text", 256).alias("text_sha256"), file.alias("_file"))
    whole = shown.groupBy("_file").agg(F.count("*").alias("_n")).join(known, "_file").where("_n = _rows").select("_file", F.lit(True).alias("_listed"))
    out = shown.join(F.broadcast(whole) if len(listed) <= BROADCAST_SHARDS else whole, "_file", "left")
    return out.select("doc_id", "lang", "source", "n_chars", "text_chars", "text_sha256", F.coalesce("_listed", F.lit(False)).alias("listed"))


OP7_SQL = """
SELECT doc_id, lang, source, n_chars, CAST(length(text) AS BIGINT) AS text_chars, sha256(text) AS text_sha256, true AS listed
FROM documents
"""

"""A file for each book, replaced as a whole or not at all.

write_books() works in two steps. Tasks write drafts below `<folder>/_drafts/<id>` and list them in a manifest of their own;
only when all of them have ended, the writer's commit sets the mark `_COMMITTED`. Until then no file of a book has been
touched, and a write that fails takes its drafts away. Then a job moves each draft to its place: a rename that replaces the
old file at once, so that a reader sees the old or the new one. The move can be repeated: a draft that is gone has
been moved. If the driver is killed in between, recover() (or the next write) ends what was committed and removes what was
not.

Folders are those that pyarrow reaches (local, HDFS, object stores, where a move is a copy). Books are told by name, which
must be a plain file name; two drafts of one book are an error before anything is moved.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from varaq.sources.book_pages import _filesystem

DRAFTS, MARK = "_drafts", "_COMMITTED"
_MANIFEST = "target string, draft string, bytes bigint"


def file_name(book: str | None, ending: str) -> str:
    if not book or book in (".", "..") or re.search(r"[/\\\x00]", book) or book.startswith("_"):
        raise ValueError(f"not a name for a file: {book!r}")
    return book + ending


@dataclass
class Written(WriterCommitMessage):
    """A task's manifest, by name, and how many drafts it lists."""

    manifest: str
    files: int


class BookFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        o = {k.lower(): v for k, v in options.items()}
        self.path, self.column, self.ending, self.id = o["path"], o["column"], o.get("ending", ""), o["id"]

    def _place(self):
        store, root = _filesystem(self.path)
        return store, f"{root.rstrip('/')}/{DRAFTS}/{self.id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, place = self._place()
        store.create_dir(place, recursive=True)
        lines = []
        for batch in iterator:
            for book, text in zip(batch.column("book").to_pylist(), batch.column(self.column).to_pylist(), strict=True):
                target, draft = file_name(book, self.ending), uuid.uuid4().hex
                raw = (text or "").encode("utf-8")
                with store.open_output_stream(f"{place}/{draft}.draft") as out:
                    out.write(raw)
                lines.append(json.dumps({"target": target, "draft": f"{draft}.draft", "bytes": len(raw)}))
        name = f"{uuid.uuid4().hex}.manifest"
        if lines:
            with store.open_output_stream(f"{place}/{name}") as out:
                out.write("\n".join(lines).encode("utf-8"))
        return Written(name, len(lines))

    def commit(self, messages) -> None:
        store, place = self._place()
        store.create_dir(place, recursive=True)
        mark = {"at": time.time(), "manifests": [m.manifest for m in messages if m is not None and m.files]}  # a name a task
        with store.open_output_stream(f"{place}/{MARK}.new") as out:
            out.write(json.dumps(mark).encode("utf-8"))
        store.move(f"{place}/{MARK}.new", f"{place}/{MARK}")

    def abort(self, messages) -> None:
        store, place = self._place()
        from pyarrow import fs

        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_dir(place)


class BookFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "book_files"

    def writer(self, schema, overwrite: bool):
        return BookFilesWriter(dict(self.options))


def _drafts(path: str) -> list[tuple[float, str, dict | None]]:
    """(time of commit, id, mark) of the writes that have left drafts; those without a mark last."""
    from pyarrow import fs

    store, root = _filesystem(path)
    found = store.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/{DRAFTS}", allow_not_found=True))
    out = []
    for f in found:
        mark = f"{f.path}/{MARK}"
        if store.get_file_info(mark).type == fs.FileType.File:
            with store.open_input_stream(mark) as file:
                m = json.loads(file.read())
            out.append((m["at"], f.base_name, m))
        else:
            out.append((float("inf"), f.base_name, None))
    return sorted(out, key=lambda x: x[:2])


def _publish(spark: SparkSession, path: str, write_id: str, mark: dict) -> int:
    """Move the drafts of a committed write to their places, in tasks; how many books it wrote."""
    from pyarrow import fs

    place = f"{path.rstrip('/')}/{DRAFTS}/{write_id}"
    n = 0
    if mark["manifests"]:
        listed = spark.read.schema(_MANIFEST).json([f"{place}/{m}" for m in mark["manifests"]])
        twice = listed.groupBy("target").count().where("count > 1").limit(5).collect()
        if twice:
            store, root = _filesystem(path)
            store.delete_dir(f"{root.rstrip('/')}/{DRAFTS}/{write_id}")
            raise ValueError(f"more than one document for {', '.join(r.target for r in twice)}")

        def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, root = _filesystem(path)
            root = root.rstrip("/")
            for pdf in batches:
                for target, draft in zip(pdf["target"], pdf["draft"], strict=True):
                    if store.get_file_info(f"{root}/{DRAFTS}/{write_id}/{draft}").type == fs.FileType.File:
                        store.move(f"{root}/{DRAFTS}/{write_id}/{draft}", f"{root}/{target}")
                yield pd.DataFrame({"n": [len(pdf)]})

        n = listed.mapInPandas(move, "n bigint").agg(F.sum("n")).first()[0] or 0
    store, root = _filesystem(path)
    store.delete_dir(f"{root.rstrip('/')}/{DRAFTS}/{write_id}")
    return n


def recover(spark: SparkSession, path: str) -> int:
    """End the writes that were committed, oldest first, and remove the drafts of those that were not; how many files the
    former moved. Nobody else may be writing to the folder."""
    store, root = _filesystem(path)
    n = 0
    for _, write_id, mark in _drafts(path):
        if mark is None:
            store.delete_dir(f"{root.rstrip('/')}/{DRAFTS}/{write_id}")
        else:
            n += _publish(spark, path, write_id, mark)
    return n


def write_books(documents: DataFrame, path: str, column: str, ending: str, name: str = "book") -> int:
    """The text of `column` of each row as `<name><ending>` below path; how many. Other files there stay."""
    spark = documents.sparkSession
    recover(spark, path)
    spark.dataSource.register(BookFiles)
    write_id = uuid.uuid4().hex
    rows = documents.select(F.col(name).cast("string").alias("book"), F.col(column).cast("string").alias("text"))
    rows.write.format("book_files").mode("append").options(column="text", ending=ending, id=write_id).save(path)
    mark = next(m for _, i, m in _drafts(path) if i == write_id)
    return _publish(spark, path, write_id, mark)

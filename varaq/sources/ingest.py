"""Ingest of large files in chunks: size, cap and SHA-256 without holding a file in memory.

Files are listed by Spark (paths and lengths only) and dealt to tasks one by one. A task reads a file chunk by
chunk; it stops at the cap, whatever the listing said, and at the first chunk if that is not the beginning of a PDF. So a file
may be larger than what Spark's reader of binary files can put into a row (2 GB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varaq.config import SETTINGS
from varaq.functions.rules import is_pdf_path
from varaq.sources.book_pages import _filesystem

CHUNK = 8 << 20
INGESTED = "name string, path string, size bigint, modified timestamp, sha256 string, error string"


def digest(stream, cap: int, chunk: int = CHUNK) -> tuple[int, str | None, str | None]:
    """(bytes read, SHA-256, error) of an open stream: at most cap bytes and one chunk are read."""
    read, folded = 0, hashlib.sha256()
    while data := stream.read(chunk):
        if read == 0 and not data.startswith(b"%PDF-"):
            return len(data), None, "not_a_pdf"
        read += len(data)
        if read > cap:
            return read, None, "too_large"
        folded.update(data)
    return (read, folded.hexdigest(), None) if read else (0, None, "not_a_pdf")


def ingested(spark: SparkSession, folder: str, max_bytes: int = SETTINGS.max_file_bytes, chunk: int = CHUNK, tasks: int | None = None) -> DataFrame:
    """name, path, size, modified, sha256, error of the files below a folder; a file that fails is a row with an error."""
    listed = spark.read.format("binaryFile").load(folder).select("path", "length", "modificationTime")
    wrong = F.when(~is_pdf_path(F.col("path")), "unsupported_type").when(F.col("length") > max_bytes, "too_large")
    listed = listed.select(F.regexp_replace("path", r"\A.*/", "").alias("name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), wrong.alias("error"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                size, sha, error = r.size, None, None
                try:
                    store, inner = _filesystem(r.path)
                    with store.open_input_stream(inner) as stream:
                        size, sha, error = digest(stream, max_bytes, chunk)
                except Exception as e:
                    error = f"unreadable: {e}"
                yield pd.DataFrame({"name": [r.name], "path": [r.path], "size": [size if error is None else r.size], "modified": [r.modified], "sha256": [sha], "error": [error]})

    good = listed.where("error is null").drop("error")
    dealt = good.repartition(tasks, "path") if tasks else good.repartition("path")
    bad = listed.where("error is not null").select("name", "path", "size", "modified", F.lit(None).cast("string").alias("sha256"), "error")
    return dealt.mapInPandas(run, INGESTED).unionByName(bad)

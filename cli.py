"""Process books: python cli.py REQUESTS OUT (--words W --cells C | --pdf FOLDER) [--ocr O] [--no-ocr] [--sidecars S] [--responses R]
[--work W [--timeout S]] [--extractor MODULE:FUNCTION --model NAME --log L].

REQUESTS, W, C and O are Parquet folders, R one of an extractor's answers, S a folder of .meta.json files, FOLDER one of PDF
files (with the library pdfplumber). OUT gets json, markdown, seed and, with answers, graph, a file for each book.

With --work each stage is written below a folder, and a later run over the same files goes on where an earlier one ended; a
file _cancel in that folder stops the run (exit status 2), also while a stage works. FUNCTION makes a client that an
extractor is asked with (varaq.operators.extraction); its answers are kept in the folder L, and lessons that have one
are not asked again.
"""

from __future__ import annotations

import argparse
import hashlib
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from varaq.operators import render, tables
from varaq.operators.requests import batch_totals, request_error, resolved
from varaq.plans import engine, staged
from varaq.sources import adapters, book_pages, books, files

#: Books up to which they are named to the source, so that the files of others are not opened.
NAMED = 1000
ENDINGS = {"json": ("json", ".json"), "markdown": ("markdown", ".md"), "seed": ("json", ".seed.json"), "graph": ("json", ".graph.json")}


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("requests")
    p.add_argument("out")
    for name in ("words", "cells", "pdf", "ocr", "sidecars", "responses", "work", "extractor", "model", "log"):
        p.add_argument(f"--{name}")
    p.add_argument("--timeout", type=float, default=None)
    p.add_argument("--opener", default="pdf", help="how book files are read; see varaq.sources.book_pages")
    p.add_argument("--no-ocr", action="store_true")
    a = p.parse_args(args)
    if bool(a.pdf) == bool(a.words):
        p.error("one of --pdf and --words is needed")
    if a.extractor and not (a.model and a.log):
        p.error("--extractor needs --model and --log")
    spark = SparkSession.builder.getOrCreate()
    side = books.sidecars(spark, a.sidecars) if a.sidecars else spark.createDataFrame([], "book string, " + books.SIDECAR)
    asked = request_error(resolved(spark.read.parquet(a.requests), side))
    good = asked.where("error is null")
    mine = lambda df: df.join(good.select("book"), "book", "left_semi")
    failed, pages, listed = spark.createDataFrame([], "book string, error string"), None, None
    if a.pdf:
        names = [r.book for r in good.select("book").limit(NAMED + 1).collect()]
        pages = mine(book_pages.read_pages(spark, a.pdf, books=names if len(names) <= NAMED else None, opener=a.opener)).persist()
        words, listed, failed = adapters.words_of(pages), adapters.listed(pages), adapters.book_errors(pages)
        cells = tables.cells_of(words, adapters.boxes_of(pages))
    else:
        words, cells = mine(spark.read.parquet(a.words)), mine(spark.read.parquet(a.cells))
    ocr = spark.read.parquet(a.ocr) if a.ocr else spark.createDataFrame([], adapters.OCR)
    lib = engine.Library(good, words, cells, ocr, use_ocr=not a.no_ocr, listed=listed)
    stages = engine.STAGES
    if a.extractor:
        module, _, function = a.extractor.partition(":")
        stages += engine.concept_stages(getattr(importlib.import_module(module), function), a.log, a.model)
    if a.work:
        options = hashlib.sha256(repr([a.no_ocr, a.opener, a.model, bool(a.pdf)]).encode()).hexdigest()[:16]
        key = f"{options}-{files.fingerprint(spark, a.requests, a.words, a.cells, a.pdf, a.ocr, a.sidecars)}"
        try:
            staged.run(lib, a.work, key, stages, progress=lambda s: print(f"stage {s}"), cancelled=lambda: files.exists(spark, f"{a.work}/_cancel"), timeout_seconds=a.timeout)
        except staged.Stopped as e:
            print(e)
            return 2
    else:
        engine.run(lib, stages)
    if a.responses:
        engine.with_graph(lib, spark.read.parquet(a.responses))
    for kind, (column, ending) in ENDINGS.items():
        if kind in lib.relations:
            render.write_each(lib[kind], f"{a.out}/{kind}", column, ending)
    for r in engine.summary(lib, a.out).where("ok").select("book", render.summary_text().alias("said")).orderBy("book").toLocalIterator():
        print(r.said)
    lib.release()
    broken = asked.select("book", "error").unionByName(failed.join(good.select("book"), "book")).groupBy("book").agg(F.max("error").alias("error"))
    totals = batch_totals(broken.selectExpr("error is null as ok")).first()
    print(totals.asDict())
    if pages is not None:
        pages.unpersist()
    return int(totals["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())

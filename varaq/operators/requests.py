"""Requests: metadata resolution, validation, batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.functions.rules import is_pdf_path
from varaq.functions.text import suspicious


def resolved(requests: DataFrame, sidecars: DataFrame) -> DataFrame:
    """requests (book, filename, title, course, grade, use_ocr) with metadata from the request, else from the
    sidecar (book, book_title, course, grade), else, for the title, from the file's stem. Empty text counts as none."""
    s = sidecars.select("book", F.col("book_title").alias("s_title"), F.col("course").alias("s_course"), F.col("grade").alias("s_grade"))
    r = requests.join(s, "book", "left")
    some = lambda *c: F.coalesce(*(F.nullif(F.col(x), F.lit("")) for x in c))
    stem = F.regexp_replace(F.regexp_replace("filename", r"\A.*/", ""), r"(?<=.)\.[^.]*\z", "")
    out = r.withColumns({"title": F.coalesce(some("title", "s_title"), stem), "course": some("course", "s_course"), "grade": some("grade", "s_grade")})
    return out.drop("s_title", "s_course", "s_grade")


def request_error(requests: DataFrame) -> DataFrame:
    """requests with error: what is wrong with a request, or null. Such rows are for quarantine, the rest go on."""
    wrong = F.when(~is_pdf_path(F.col("filename")), "unsupported_type")
    for c in ("title", "course", "grade"):
        wrong = wrong.when(suspicious(F.col(c)), "suspicious_encoding")
    return requests.withColumn("error", wrong)


def batch_totals(results: DataFrame) -> DataFrame:
    """total, ok, failed over results (ok boolean)."""
    return results.agg(F.count("*").alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))

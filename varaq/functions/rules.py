"""Predicates and small rules as Column expressions: style, files, access, jobs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varaq.config import SETTINGS
from varaq.functions.text import is_blank

# Names of states, stages and types.
STATES = ("received", "validating", "queued", "downloading", "ready", "processing", "extracting", "ocr", "exporting", "completed", "failed", "cancel_requested", "cancelled")
TERMINAL = ("completed", "failed", "cancelled")
RUNNING = ("downloading", "ready", "processing", "extracting", "ocr", "exporting", "cancel_requested")
STAGE_STATE = {
    "extract_pages": "extracting",
    "build_document": "processing",
    "build_outline": "processing",
    "export": "exporting",
    "export_outline": "exporting",
    "extract_concepts": "processing",
    "export_knowledge_graph": "exporting",
}
RELATION_TYPES = ("prerequisite", "depends_on", "parent", "child", "related", "similar", "opposite", "frequently_confused")
PDF_TYPES = ("application/pdf", "application/x-pdf", "application/octet-stream")


def is_grey(color: Column) -> Column:
    """Black, grey or white ink in a grey, RGB or CMYK colour."""
    c = lambda k: F.try_element_at(color, F.lit(k))
    spread = F.greatest(F.abs(c(1) - c(2)), F.abs(c(2) - c(3)), F.abs(c(1) - c(3)))
    return F.when(F.coalesce(F.size(color), F.lit(0)) < 3, F.lit(True)).otherwise(spread < SETTINGS.grey_tolerance)


def heading_score(ratio: Column, colored: Column, bold: Column, chars: Column) -> Column:
    s, zero = SETTINGS, F.lit(0.0)
    size = F.when(ratio >= s.size_ratio_strong, s.score_strong).when(ratio >= s.size_ratio_weak, s.score_weak).otherwise(zero)
    return size + F.when(colored, s.score_colour).otherwise(zero) + F.when(bold, s.score_bold).otherwise(zero) + F.when(chars > s.long_line, s.score_long).otherwise(zero)


def classified(text: Column, avg_size: Column, colored: Column, bold: Column, baseline: Column) -> Column:
    """struct(type, confidence, reason) of a line."""
    s = SETTINGS
    ratio = avg_size / F.when(baseline > 0, baseline).otherwise(F.lit(s.default_size))
    score = heading_score(ratio, colored, bold, F.length(text))
    reasons = F.concat_ws(
        "; ",
        F.when(ratio >= s.size_ratio_weak, F.format_string("size_ratio=%.2f", F.bround(ratio, 2))),
        F.when(colored, "colored_ink"),
        F.when(bold, "bold_font"),
        F.when(F.length(text) > s.long_line, "long_line_penalty"),
    )
    reasons = F.when(reasons == "", "body_text").otherwise(reasons)
    blank, heading = is_blank(text), score >= s.heading_score
    one = F.lit(1.0)
    return F.struct(
        F.when(~blank & heading, "heading").otherwise("paragraph").alias("type"),
        F.when(blank, one).when(heading, F.least(score, one)).otherwise(F.least(F.greatest(1.0 - score, F.lit(0.5)), one)).alias("confidence"),
        F.when(blank, "empty_line").otherwise(reasons).alias("reason"),
    )


def is_pdf_path(path: Column) -> Column:
    return F.lower(path).endswith(".pdf")


def is_pdf_content(content: Column) -> Column:
    return F.substring(content, 1, 5) == F.lit(b"%PDF-")


def upload_error(filename: Column, mime: Column, size: Column, limit: int = SETTINGS.max_file_bytes) -> Column:
    """Why an upload is refused, or null. Empty and missing values are not held against it."""
    return (
        F.when((F.coalesce(filename, F.lit("")) != "") & ~is_pdf_path(filename), "extension")
        .when((F.coalesce(mime, F.lit("")) != "") & ~F.lower(mime).isin(*PDF_TYPES), "mime")
        .when(size > limit, "too_large")
        .when(size <= 0, "empty")
    )


def allow_list(csv: Column) -> Column:
    """Positive ids, each once, in order; empty if any item is not one."""
    items = F.transform(F.split(F.trim(csv), ",", -1), lambda x: F.trim(x))
    ids = F.transform(items, lambda x: F.when(x.rlike(r"\A[+]?[0-9]+\z"), x.try_cast("bigint")))
    good = ~F.exists(ids, lambda x: x.isNull() | (x <= 0))
    return F.when(F.coalesce(good, F.lit(False)), F.array_distinct(ids)).otherwise(F.array().cast("array<bigint>"))


def may_use(user_id: Column, allowed: Column, everyone: Column) -> Column:
    return F.coalesce(everyone, F.lit(False)) | F.coalesce(F.array_contains(allowed, user_id), F.lit(False))


def within_roots(path: Column, roots: list[str]) -> Column:
    """The path, free of steps upwards, lies under one of the roots."""
    clean = ~path.rlike(r"(^|/)\.\.(/|$)")
    under = F.lit(False)
    for r in roots:
        under = under | path.startswith(r.rstrip("/") + "/")
    return clean & under


def _seconds(c: Column) -> Column:
    return F.unix_seconds(c.cast("timestamp"))


def elapsed_seconds(created: Column, started: Column, completed: Column, now: Column) -> Column:
    return F.greatest(F.lit(0), _seconds(F.coalesce(completed, now)) - _seconds(F.coalesce(started, created)))


def state_of_stage(stage: Column) -> Column:
    pairs = [x for k, v in STAGE_STATE.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), stage), F.lit("processing"))


def mean_confidence(values: Column) -> Column:
    """Mean of the readable values that are not negative, or null."""
    numbers = F.filter(F.transform(values, lambda x: x.try_cast("double")), lambda x: x.isNotNull() & (x >= 0))
    return F.when(F.size(numbers) > 0, F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x) / F.size(numbers))


def safe_error(cancelled: Column) -> Column:
    """What users are told; never the exception's own text."""
    return F.when(cancelled, "پردازش به درخواست کاربر متوقف شد").otherwise("خطای پردازش فایل")


@F.pandas_udf(T.StringType())
def nfkc(names: pd.Series) -> pd.Series:
    """Unicode's NFKC, which has no built-in."""
    return names.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def safe_pdf_name(name: Column, fallback_id: Column) -> Column:
    """A file name that is safe to store. `name` should be in NFKC, see nfkc()."""
    default = F.concat(F.lit("document-"), fallback_id, F.lit(".pdf"))
    raw = F.coalesce(F.nullif(name, F.lit("")), default)
    safe = F.regexp_replace(raw, r"[^\p{L}\p{N} ._()-]", "_")
    safe = F.regexp_replace(safe, r"\A[ ._]+|[ ._]+\z", "")
    safe = F.regexp_replace(F.substring(safe, 1, 180), r"\A[ .]+|[ .]+\z", "")
    safe = F.when(safe == "", default).otherwise(safe)
    stem = F.regexp_replace(safe, r"(?<=.)\.[^.]*\z", "")
    return F.when(is_pdf_path(safe), safe).otherwise(F.concat(stem, F.lit(".pdf")))


def missing_languages(required: Column, installed: Column) -> Column:
    """Of "a+b" the languages that are not installed, sorted."""
    wanted = F.filter(F.transform(F.split(required, r"\+"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_sort(F.array_except(wanted, installed))


def encoded_list(values: Column) -> Column:
    """A list as JSON text, as the job table's files hold it."""
    return F.to_json(F.coalesce(values, F.array().cast("array<string>")))


def decoded_list(text: Column) -> Column:
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def encoded_time(time: Column) -> Column:
    """A time as ISO text in UTC."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def decoded_time(text: Column) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")

"""Chapters, lessons and subtopics from the pages of a table of contents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.config import SETTINGS
from varaq.functions.text import CHAPTER, SPACE, digits_to_int, label, strip
from varaq.operators.lines import PAGE

# Headings of a contents page; only the first is skipped as a line.
TOC_TITLES = ("فهرست", "فهرست مطالب")
_ENTRY = rf"(?d)\A(.+?)\.{{2,}}[{SPACE}]*([0-9\x{{660}}-\x{{669}}\x{{6f0}}-\x{{6f9}}]+)[{SPACE}]*\z"


def toc_pages(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    headed = blocks.where((F.col("type") == "heading") & strip(F.col("text")).isin(*TOC_TITLES))
    return pages.join(headed.select(*PAGE).distinct(), [*PAGE], "left_semi")


def toc_lines(pages: DataFrame) -> DataFrame:
    """book, page, line_no, line of contents pages."""
    return pages.select(*PAGE, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def toc_entries(lines: DataFrame) -> DataFrame:
    """book, seq, title (what wrapped lines before it held put in front), printed page.

    lines: book, page, line_no, line. A contents table is small, so a book's is ordered in one window.
    """
    rows = lines.select("book", "page", "line_no", strip(F.col("line")).alias("line")).where((F.col("line") != "") & (F.col("line") != TOC_TITLES[0]))
    entry = F.regexp_extract("line", _ENTRY, 2) != ""
    order = Window.partitionBy("book").orderBy("page", "line_no")
    rows = rows.withColumn("entry", entry)
    rows = rows.withColumn("seq", F.coalesce(F.sum(F.col("entry").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    part = F.when(F.col("entry"), strip(F.regexp_extract("line", _ENTRY, 1))).otherwise(F.col("line"))
    parts = F.array_sort(F.collect_list(F.struct("page", "line_no", part.alias("x"))))
    title = strip(F.array_join(F.transform(parts, lambda p: p["x"]), " "))
    number = F.max(F.when(F.col("entry"), digits_to_int(F.regexp_extract("line", _ENTRY, 2))))
    out = rows.groupBy("book", "seq").agg(title.alias("title"), number.alias("page"), F.bool_or("entry").alias("whole"))
    return out.where("whole").drop("whole")


def outline(entries: DataFrame) -> DataFrame:
    """book, seq, role, order, title, page, chapter_seq, lesson_seq.

    A lesson before any chapter is lost with its subtopics; a new chapter ends the lesson before it; what has no
    label and no lesson is dropped.
    """
    e = entries.withColumn("l", label(F.col("title"), SETTINGS.toc_label_prefix))
    before = strip(F.substring("title", F.lit(1), F.col("l.start")))
    named = strip(F.concat_ws(" ", F.nullif(before, F.lit("")), F.nullif(F.col("l.rest"), F.lit(""))))
    e = e.withColumn("role", F.when(F.col("l").isNull(), "subtopic").when(F.col("l.kind") == CHAPTER, "chapter").otherwise("lesson"))
    shown = F.when(F.col("l").isNull() | (named == ""), F.col("title")).otherwise(named)
    past = Window.partitionBy("book").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    chapter = F.last(F.when(F.col("role") == "chapter", F.col("seq")), True).over(past)
    lesson = F.last(F.when(F.col("role") == "chapter", F.lit(-1)).when(F.col("role") == "lesson", F.col("seq")), True).over(past)
    e = e.select("book", "seq", "role", F.col("l.order").alias("order"), shown.alias("title"), "page", chapter.alias("chapter_seq"), lesson.alias("lesson_seq"))
    keep = F.col("chapter_seq").isNotNull() & ((F.col("role") != "subtopic") | (F.col("lesson_seq") >= 0))
    return e.where(keep).withColumn("lesson_seq", F.when(F.col("role") != "chapter", F.nullif("lesson_seq", F.lit(-1))))


def outline_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("book").agg(*(F.count_if(F.col("role") == r).alias(f"{r}s") for r in ("chapter", "lesson", "subtopic")))

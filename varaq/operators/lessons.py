"""From printed to physical pages, and the text of each lesson."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.functions.text import CHAPTER, LESSON, label


def printed_pages(outline: DataFrame) -> DataFrame:
    """book, kind, order, printed: of entries with the same label the last."""
    named = outline.where("role <> 'subtopic' and page is not null")
    kind = F.when(F.col("role") == "chapter", CHAPTER).otherwise(LESSON)
    return named.groupBy("book", kind.alias("kind"), "order").agg(F.max_by("page", "seq").alias("printed"))


def offsets(blocks: DataFrame, outline: DataFrame) -> DataFrame:
    """book, offset: physical less printed page, the most frequent over headings; of equals the first seen."""
    heads = blocks.where("type = 'heading'").withColumn("l", label(F.col("text"))).where("l is not null")
    heads = heads.select("book", "page", "block_index", F.col("l.kind").alias("kind"), F.col("l.order").alias("order"))
    found = heads.join(printed_pages(outline), ["book", "kind", "order"])
    counted = found.groupBy("book", (F.col("page") - F.col("printed")).alias("offset")).agg(F.count("*").alias("n"), F.min(F.struct("page", "block_index")).alias("first"))
    rank = F.struct(F.col("n"), (-F.col("first.page")).alias("p"), (-F.col("first.block_index")).alias("b"))
    return counted.groupBy("book").agg(F.max_by("offset", rank).alias("offset"))


def lesson_ranges(outline: DataFrame, offset: DataFrame, counts: DataFrame) -> DataFrame:
    """book, seq, order, title, chapter_seq, start_page, end_page, in outline order.

    A lesson ends before the next one's page; the last at the book's end. A range may be empty.
    """
    lessons = outline.where("role = 'lesson' and page is not null").join(offset, "book").join(counts.select("book", "total_pages"), "book")
    after = F.lead("page").over(Window.partitionBy("book").orderBy("seq"))
    start = F.greatest(F.col("page") + F.col("offset"), F.lit(1))
    end = F.coalesce(after + F.col("offset") - 1, F.col("total_pages"))
    ranges = lessons.withColumns({"start_page": start, "end": end})
    return ranges.select("book", "seq", "order", "title", "chapter_seq", "start_page", F.least(F.greatest("end", "start_page"), "total_pages").alias("end_page"))


def lesson_pages(ranges: DataFrame, pages: DataFrame) -> DataFrame:
    """A row for each lesson and page of its range: the range is spelled out, so the join is on equal pages."""
    listed = F.when(F.col("start_page") <= F.col("end_page"), F.sequence("start_page", "end_page"))
    spelled = ranges.select("book", "seq", F.explode(listed).alias("page"))
    return spelled.join(pages.select("book", F.col("page").cast("bigint").alias("page"), "text"), ["book", "page"])


def lesson_extracts(ranges: DataFrame, pages: DataFrame) -> DataFrame:
    """ranges with the lesson's text and its source pages; a lesson without pages stays, with empty text."""
    own = lesson_pages(ranges, pages)
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    full = F.filter(ordered, lambda x: F.coalesce(x["text"], F.lit("")) != "")
    texts = own.groupBy("book", "seq").agg(
        F.array_join(F.transform(full, lambda x: x["text"]), "\n\n").alias("text"), F.transform(ordered, lambda x: x["page"]).alias("source_pages")
    )
    out = ranges.join(texts, ["book", "seq"], "left")
    return out.withColumns({"text": F.coalesce("text", F.lit("")), "source_pages": F.coalesce("source_pages", F.array().cast("array<bigint>"))})


def prompts(extracts: DataFrame) -> DataFrame:
    """The message that an extractor is sent for each lesson. Needs book_title, course, grade, chapter_title, title, text."""
    given = lambda c, name: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(name), F.col(c)))
    head = F.concat_ws(
        "\n",
        F.concat(F.lit("کتاب: "), "book_title"),
        given("course", "درس/رشته: "),
        given("grade", "پایه: "),
        F.concat(F.lit("فصل: "), "chapter_title"),
        F.concat(F.lit("عنوان درس: "), "title"),
    )
    return extracts.withColumn("prompt", F.concat(head, F.lit("\n\n---\n\n"), F.col("text")))

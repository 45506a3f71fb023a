"""Blocks of a page in reading order: headings, merged paragraphs, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.config import SETTINGS
from varaq.functions.text import clean, is_blank
from varaq.operators.lines import PAGE
from varaq.operators.tables import listed_by_band, page_band


def outside_tables(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Lines that lie in no table's rows; where they stand across the page does not matter.

    A page's tables are listed by the bands of the page that they cross, so that a line meets those at its height only. They
    are joined by page alone: lines that were dealt by page stay.
    """
    slack = SETTINGS.exclusion_slack
    t, b = F.col("table_top") - slack, F.col("table_bottom") + slack
    boxes = listed_by_band(tables, t, b, F.struct(t.alias("t"), b.alias("b")))
    near = F.element_at("_bands", page_band(F.col("top")))
    inside = F.exists(near, lambda x: (F.col("top") >= x["t"]) & (F.col("bottom") <= x["b"]))
    return lines.join(boxes, [*PAGE], "left").where(~F.coalesce(inside, F.lit(False))).select(*lines.columns)


def page_items(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Classified lines and labelled tables of each page; at the same height lines come first."""
    none = F.lit(None)
    own = outside_tables(lines.where(~is_blank(F.col("text"))), tables).select(
        "book", "page", "top", F.lit(0).alias("kind"), F.col("band").alias("seq"), "type", "text", "confidence", "reason",
        none.cast("array<array<string>>").alias("rows"), none.cast("double").alias("fill_ratio"),
    )
    boxes = tables.select(
        "book", "page", "top", F.lit(1).alias("kind"), F.col("table_no").cast("double").alias("seq"), "type", F.col("block_text").alias("text"), "confidence",
        none.cast("string").alias("reason"), "rows", "fill_ratio",
    )
    return own.unionByName(boxes)


def blocks_of(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """book, page, block_index, id, type, text, confidence, reason, rows, fill_ratio, top, source (both of tables only).

    Paragraph lines that follow each other become one block; headings and tables stand alone.
    """
    items = page_items(lines, tables)
    order = Window.partitionBy(*PAGE).orderBy("top", "kind", "seq")
    flowing = (F.col("kind") == 0) & (F.col("type") == "paragraph")
    starts = ~(F.col("flowing") & F.coalesce(F.lag("flowing").over(order), F.lit(False)))
    items = items.withColumn("flowing", flowing).withColumn("starts", starts)
    items = items.withColumn("block_index", F.sum(F.col("starts").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("top", "kind", "seq", "text"))), lambda x: x["text"]), "\n")
    one = lambda c: F.first(c).alias(c)  # noqa: E731  every column but the text is the same in a block, or not shown
    out = items.groupBy(*PAGE, "block_index").agg(text.alias("raw"), one("flowing"), one("kind"), one("type"), one("confidence"), one("reason"), one("rows"), one("fill_ratio"), F.min("top").alias("top"))
    bordered = F.col("kind") == 1
    return out.select(
        "book",
        "page",
        "block_index",
        F.concat_ws("-", F.col("page").cast("string"), F.col("block_index").cast("string")).alias("id"),
        "type",
        F.when(bordered, F.col("raw")).otherwise(clean(F.col("raw"))).alias("text"),
        F.when(~F.col("flowing"), F.bround("confidence", 2)).alias("confidence"),
        F.when(~F.col("flowing"), F.col("reason")).alias("reason"),
        "rows",
        "fill_ratio",
        F.when(bordered, F.col("top")).alias("top"),
        F.when(bordered, "bordered_region").alias("source"),
    )

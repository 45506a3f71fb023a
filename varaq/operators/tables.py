"""Bordered regions of a page: statistics, rejection, and what kind of block they are.

cells: book, page, table_no, row_no, col_no, text (null: no such cell), top (of the cell, null: none), table_x0,
table_top, table_x1, table_bottom, page_w, page_h. Texts are those of region_text() over a cell's words, cleaned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varaq.config import SETTINGS
from varaq.functions.text import clean, is_blank
from varaq.operators.lines import region_text

TABLE = ("book", "page", "table_no")


def table_stats(cells: DataFrame) -> DataFrame:
    """One row a region: its texts by row, counts, fill, area share and place."""
    cells = cells.withColumn("cell", F.coalesce("text", F.lit("")))
    newlines = F.length("cell") - F.length(F.replace("cell", F.lit("\n"), F.lit("")))
    rows = cells.groupBy(*TABLE, "row_no").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("col_no", "cell"))), lambda x: x["cell"]).alias("row"),
        F.count("*").alias("width"),
        F.count_if(~is_blank(F.col("cell"))).alias("filled"),
        F.max(newlines).alias("newlines"),
        F.min("top").alias("top"),
        *(F.first(c).alias(c) for c in ("table_x0", "table_top", "table_x1", "table_bottom", "page_w", "page_h")),
    )
    area = F.greatest(F.col("table_x1") - F.col("table_x0"), F.lit(0.0)) * F.greatest(F.col("table_bottom") - F.col("table_top"), F.lit(0.0))
    page = F.coalesce("page_w", F.lit(0.0)) * F.coalesce("page_h", F.lit(0.0))
    tables = rows.groupBy(*TABLE).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("row_no", "row"))), lambda x: x["row"]).alias("rows"),
        F.count("*").alias("n_rows"),
        F.max("width").alias("n_cols"),
        F.sum("width").alias("n_cells"),
        F.sum("filled").alias("n_filled"),
        F.max("newlines").alias("max_newlines"),
        F.coalesce(F.min("top"), F.lit(0.0)).alias("top"),
        *(F.first(c).alias(c) for c in ("table_x0", "table_top", "table_x1", "table_bottom", "page_w", "page_h")),
    )
    return tables.withColumns({"fill": F.col("n_filled") / F.col("n_cells"), "area": F.when(page > 0, area / page).otherwise(F.lit(0.0))})


def accepted(tables: DataFrame) -> DataFrame:
    """Regions that become blocks: large enough, not a page misread as a table, not empty."""
    s = SETTINGS
    false = (F.col("area") > s.false_table_area) & (F.col("max_newlines") > s.false_table_newlines)
    return tables.where((F.col("n_rows") >= s.table_rows) & (F.col("n_cols") >= s.table_cols) & ~false & (F.col("n_filled") > 0))


def labelled(tables: DataFrame) -> DataFrame:
    """accepted tables with type, text and confidence. A sparse region is a title or a paragraph, never dropped."""
    texts = F.filter(F.flatten("rows"), lambda x: ~is_blank(x))
    combined = F.array_join(texts, " — ")
    grid = F.array_join(F.transform("rows", lambda r: F.array_join(r, " | ")), "\n")
    full = F.col("fill") >= SETTINGS.table_fill
    title = F.length(combined) <= SETTINGS.title_chars
    return tables.withColumns(
        {
            "type": F.when(full, "table").when(title, "heading").otherwise("paragraph"),
            "block_text": F.when(full, grid).otherwise(combined),
            "confidence": F.when(full, F.bround("fill", 2)).when(title, F.lit(0.4)).otherwise(F.lit(0.3)),
            "fill_ratio": F.bround("fill", 2),
        }
    )


#: Height of a band of a page in points, and how far bands go; what lies beyond is in the last one.
BAND, FAR = 16.0, 14400.0


def page_band(y: Column) -> Column:
    """The band of a page that a height lies in. Bands rise with y, so what lies between two heights lies in or between
    their bands."""
    return F.floor(F.greatest(F.least(y, F.lit(FAR)), F.lit(-FAR)) / BAND)


def page_bands(top: Column, bottom: Column) -> Column:
    """All bands from top to bottom, for one row each; none if a height is missing or they are the wrong way round."""
    return F.explode(F.when(top <= bottom, F.sequence(page_band(top), page_band(bottom))))


def listed_by_band(boxes: DataFrame, top: Column, bottom: Column, box: Column) -> DataFrame:
    """book, page, _bands: the boxes of a page in a map by the bands that they cross, a row a page."""
    b = boxes.select("book", "page", page_bands(top, bottom).alias("_band"), box.alias("_box"))
    b = b.groupBy("book", "page", "_band").agg(F.collect_list("_box").alias("_boxes"))
    return b.groupBy("book", "page").agg(F.map_from_entries(F.collect_list(F.struct("_band", "_boxes"))).alias("_bands"))


def words_in_cells(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """Words with table_no, row_no and col_no of the cell that their centre lies in.

    boxes: book, page, table_no, row_no, col_no, x0, top, x1, bottom. A page's cells are listed by the bands that they cross,
    so that a word meets the cells at its height only. They are joined by page alone: words that were dealt by page stay.
    """
    b = listed_by_band(boxes, F.col("top"), F.col("bottom"), F.struct("table_no", "row_no", "col_no", "x0", "top", "x1", "bottom"))
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("top") + F.col("bottom")) / 2
    met = words.join(b, ["book", "page"]).select(*words.columns, F.explode(F.element_at("_bands", page_band(y))).alias("_box"))
    inside = (x >= F.col("_box.x0")) & (x < F.col("_box.x1")) & (y >= F.col("_box.top")) & (y < F.col("_box.bottom"))
    return met.where(inside).select(*words.columns, "_box.table_no", "_box.row_no", "_box.col_no")


def cells_of(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """cells, as table_stats() takes them, from the words of the pages and the boxes of their cells.

    boxes: book, page, table_no, row_no, col_no, x0, top, x1, bottom (null: no such cell) and the columns of a table.
    """
    keys = (*TABLE, "row_no", "col_no")
    text = region_text(words_in_cells(words, boxes.where("x0 is not null")), keys).select(*keys, clean(F.col("text")).alias("text"))
    return boxes.join(text, [*keys], "left").select(*keys, F.when(F.col("x0").isNotNull(), F.coalesce("text", F.lit(""))).alias("text"), "top", "table_x0", "table_top", "table_x1", "table_bottom", "page_w", "page_h")

"""From positioned words to styled lines.

words: book, page, word_no, text, x0, x1, top, bottom, size, fontname, color array<double>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varaq.config import SETTINGS
from varaq.functions.rules import classified, is_grey
from varaq.functions.text import clean, fix_glyphs, is_blank
from varaq.sources.files import sized

PAGE = ("book", "page")


def band(top: Column) -> Column:
    """Words of one line share a band; halves go to the even band. rint() rounds the double itself, without a decimal."""
    return F.rint(top / SETTINGS.line_band) * SETTINGS.line_band + 0.0  # no negative zero


#: Bits of a word's looks.
_BOLD, _COLORED = 1, 2


def lines_of(words: DataFrame, keys: tuple[str, ...] = PAGE) -> DataFrame:
    """One row a line: text in reading order, its box, mean size, and whether any word is bold or coloured.

    What is asked of a word alone is asked before words are grouped, so that grouping holds no fonts and inks. `looks` is
    used twice, for which Spark leaves it there.
    """
    bold = F.lower(F.coalesce("fontname", F.lit(""))).contains("bold")
    colored = F.coalesce(F.size("color"), F.lit(0)).cast("int").between(1, 1 << 20) & ~is_grey(F.col("color"))
    bit = lambda is_so, n: F.when(F.coalesce(is_so, F.lit(False)), F.lit(n)).otherwise(F.lit(0))
    w = words.select(
        *keys, band(F.col("top")).alias("band"), F.struct((-F.col("x0")).alias("x"), "word_no", fix_glyphs(F.col("text")).alias("w")).alias("word"), "top", "bottom", "x0", "x1",
        F.coalesce("size", F.lit(0.0)).alias("size"), (bit(bold, _BOLD) + bit(colored, _COLORED)).alias("looks"),
    )
    looks = F.bit_or("looks")
    return w.groupBy(*keys, "band").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("word")), lambda x: x["w"]), " ").alias("text"),
        F.min("top").alias("top"),
        F.max("bottom").alias("bottom"),
        F.min("x0").alias("x0"),
        F.max("x1").alias("x1"),
        F.avg("size").alias("avg_size"),
        (looks.bitwiseAND(_BOLD) != 0).alias("is_bold"),
        (looks.bitwiseAND(_COLORED) != 0).alias("is_colored"),
    )


def region_text(words: DataFrame, keys: tuple[str, ...] = PAGE) -> DataFrame:
    """The text of a region (page, cell): its lines from top to bottom."""
    lines = lines_of(words, keys)
    ordered = F.sort_array(F.collect_list(F.struct("band", "text")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))


def baselines(lines: DataFrame) -> DataFrame:
    """book, baseline: the median size of its lines that have text and a size."""
    sized = F.when((F.col("avg_size") != 0) & ~is_blank(F.col("text")), F.col("avg_size"))
    return lines.groupBy("book").agg(F.coalesce(F.median(sized), F.lit(SETTINGS.default_size)).alias("baseline"))


def classify(lines: DataFrame) -> DataFrame:
    """lines with type, confidence and reason, each book by its own baseline.

    Baselines are written out first: by the size of the file Spark sends a few to all tasks, so that lines stay where they
    are and are not gathered by book; many are joined by a shuffle.
    """
    found = sized(baselines(lines), "baselines")
    kind = classified(F.col("text"), F.col("avg_size"), F.col("is_colored"), F.col("is_bold"), F.col("baseline"))
    return lines.join(found, "book").withColumn("c", kind).select(*lines.columns, "baseline", "c.*")


def page_texts(lines: DataFrame) -> DataFrame:
    """book, page and the page's cleaned text, tables included."""
    ordered = F.sort_array(F.collect_list(F.struct("band", "text")))
    joined = F.array_join(F.transform(ordered, lambda x: x["text"]), "\n")
    return lines.groupBy(*PAGE).agg(clean(joined).alias("text"))

"""Containment by bands: the same as comparing every word and line with every cell and table of its page."""

import random

from pyspark.sql import functions as F

from varaq.operators import blocks, tables

WORD = "book string, page int, word_no int, x0 double, x1 double, top double, bottom double"
BOX = "book string, page int, table_no int, row_no int, col_no int, x0 double, top double, x1 double, bottom double"


def test_words_meet_the_cells_at_their_height_only(spark):
    """A page of 10,000 words and 2,000 cells: all that all pairs give, with a few hundredths of the pairs."""
    rng = random.Random(3)
    cells = [("b", 1, 1, r, c, 12.0 * c, 18.0 * r, 12.0 * c + 12, 18.0 * r + 18) for r in range(50) for c in range(40)]
    cells += [("b", 1, 2, 1, 1, -1e9, -1e9, 1e9, 1e9), ("b", 1, 3, 1, 1, 5.0, 90.0, 50.0, 20.0), ("b", 1, 4, 1, 1, None, None, None, None), ("b", 2, 1, 1, 1, 0.0, 0.0, 9.0, 16.0)]
    words = [("b", 1, k, x, x + 4, y, y + rng.choice([0, 8])) for k in range(10_000) for x, y in [(rng.uniform(-20, 520), rng.choice([rng.uniform(-50, 950), 18.0 * rng.randrange(51), 16.0 * rng.randrange(60)]))]]
    words += [("b", 1, 20_000, 0.0, 0.0, 1e8, 1e8), ("b", 2, 1, 0.0, 0.0, 16.0, 16.0), ("b", 2, 2, 0.0, 0.0, 15.9, 15.9), ("c", 1, 1, 0.0, 0.0, 0.0, 0.0)]
    w, b = spark.createDataFrame(words, WORD), spark.createDataFrame(cells, BOX)
    got = sorted((r.page, r.word_no, r.table_no, r.row_no, r.col_no) for r in tables.words_in_cells(w, b).collect())
    want = []
    for _, page, k, x0, x1, top, bottom in words[:10_000:7] + words[10_000:]:
        x, y = (x0 + x1) / 2, (top + bottom) / 2
        want += [(page, k, t, r, c) for book, p, t, r, c, a0, at, a1, ab in cells if book == _ and p == page and a0 is not None and a0 <= x < a1 and at <= y < ab]
    some = {(p, k) for name, p, k, *_ in words[:10_000:7] + words[10_000:] if name == "b"}
    assert [x for x in got if x[:2] in some] == sorted(want) and want
    assert tables.words_in_cells(w, b).columns == [*w.columns, "table_no", "row_no", "col_no"]
    banded = b.select("book", "page", tables.page_bands(F.col("top"), F.col("bottom")).alias("_band"))
    pairs = w.withColumn("_band", tables.page_band((F.col("top") + F.col("bottom")) / 2)).join(banded, ["book", "page", "_band"]).count()
    assert pairs < len(words) * len(cells) / 15


def test_lines_outside_tables(spark):
    rng = random.Random(4)
    lines = [("b", rng.randrange(3), float(k), t, t + rng.choice([0, 5, 300])) for k in range(500) for t in [rng.choice([rng.uniform(-40, 900), 100.0, 99.0, 98.999, 201.0])]] + [("b", 1, 900.0, 1e7, 1e7)]
    boxes = [("b", 1, 100.0, 200.0), ("b", 1, 500.0, 400.0), ("b", 2, -1e6, 1e6), ("b", 0, None, None), ("b", 1, 1e6, 1e8)]
    df = spark.createDataFrame(lines, "book string, page int, band double, top double, bottom double")
    t = spark.createDataFrame(boxes, "book string, page int, table_top double, table_bottom double")
    want = sorted(x for x in lines if not any(p == x[1] and a is not None and x[3] >= a - 1 and x[4] <= b + 1 for _, p, a, b in boxes))
    assert sorted(map(tuple, blocks.outside_tables(df, t).collect())) == want and want

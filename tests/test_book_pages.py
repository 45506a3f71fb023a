"""The page data source: ranges of pages, filters, columns, broken pages and files, over JSON lines and a stub of the library."""

import json
import os
import sys
from types import SimpleNamespace as N

import pytest
from pyspark.sql import functions as F

from varaq.operators import pages as page_ops
from varaq.plans import engine
from varaq.sources import adapters, book_pages

WORD = {"word_no": 0, "text": "متن", "x0": 1.0, "x1": 2.0, "top": 3.0, "bottom": 4.0, "size": 12.0, "fontname": "f", "color": [0.0]}
BOX = {"table_no": 1, "row_no": 1, "col_no": 1, "x0": 0.0, "top": 0.0, "x1": 9.0, "bottom": 9.0, "table_x0": 0.0, "table_top": 0.0, "table_x1": 9.0, "table_bottom": 9.0}


def line(n, words=1, **more):
    return json.dumps({"page": n, "page_w": 600.0, "page_h": 800.0, "words": [{**WORD, "word_no": k, "text": f"w{n}.{k}"} for k in range(words)], "boxes": [BOX] if n % 2 else [], **more}, ensure_ascii=False)


@pytest.fixture
def folder(spark, tmp_path):
    book_pages.register(spark)
    tmp_path = tmp_path / "کتاب ها"
    tmp_path.mkdir()
    (tmp_path / "a.jsonl").write_text("\n".join(line(n, 2) for n in range(1, 41)) + "\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text("\n".join([line(3), line(1), line(2)]), encoding="utf-8")  # any order, no last newline
    (tmp_path / "broken.jsonl").write_text("what\n", encoding="utf-8")
    (tmp_path / "empty.jsonl").write_text("", encoding="utf-8")
    (tmp_path / "bad.jsonl").write_text("\n".join([line(1), '{"page": 2, "words": [', line(3, words=1, page_w="wide"), line(4)]) + "\n", encoding="utf-8")
    (tmp_path / "_note.jsonl").write_text("not read")
    inner = tmp_path / "book=%D8%A8" / "deep"
    inner.parent.mkdir()
    (inner.parent / "part-0.txt").write_text(line(7) + "\n", encoding="utf-8")
    return f"file://{tmp_path}"


def load(spark, folder, relation="pages", schema=None, **options):
    r = spark.read.format("book_pages").option("opener", "lines").option("relation", relation).options(**options)
    return (r.schema(schema) if schema else r).load(folder)


def test_pages_words_and_boxes_of_all_files(spark, folder):
    got = {(r.book, r.page): r for r in load(spark, folder).collect()}
    assert sorted(k for k in got if k[0] != "a") == [("b", 1), ("b", 2), ("b", 3), ("bad", 1), ("bad", 2), ("bad", 3), ("bad", 4), ("broken", 0), ("ب", 7)]
    assert [k[1] for k in sorted(got) if k[0] == "a"] == list(range(1, 41))
    assert got["b", 3].words[0].text == "w3.0" and got["b", 3].page_w == 600.0 and got["b", 2].boxes == []
    assert got["bad", 2].error and got["bad", 3].error and got["bad", 4].error is None and got["broken", 0].error.startswith("line 1")
    words = load(spark, folder, "words")
    assert words.where("book = 'a'").count() == 80 and words.columns[:4] == ["book", "page", "word_no", "text"]
    boxes = load(spark, folder, "boxes")
    assert boxes.where("book = 'a'").count() == 20 and boxes.first().page_w == 600.0
    assert {r.book for r in words.select("book").distinct().collect()} == {"a", "b", "bad", "ب"}
    with pytest.raises(Exception, match="no relation"):
        load(spark, folder, "lines").count()


def test_a_large_file_is_spread_and_every_page_read_once(spark, folder):
    df = load(spark, folder + "/a.jsonl", split_bytes="600")
    assert df.rdd.getNumPartitions() > 5
    assert [r.page for r in df.select("page").orderBy("page").collect()] == list(range(1, 41))
    assert load(spark, folder + "/a.jsonl").rdd.getNumPartitions() == 1
    many = load(spark, folder, split_bytes="9000")
    assert many.count() == load(spark, folder).count()



def open_counting():
    """Writes down what is opened and read, for the tests that look at filters and columns."""
    opened = book_pages.open_lines()

    def f(file):
        book = opened(file)
        log = os.environ["VARAQ_TEST_LOG"]

        def read(n, words, boxes):
            with open(log, "a") as out:
                out.write(f"{n} {int(words)} {int(boxes)}\n")
            return book.read(n, words, boxes)

        return book_pages.Book(book.numbers, read)

    return f


def test_filters_open_only_their_pages_and_columns_only_what_they_need(spark, folder, tmp_path, monkeypatch):
    log = tmp_path / "log"
    reader = lambda **o: book_pages.BookPagesReader({"path": folder, "opener": "tests.test_book_pages:open_counting", "suffix": r"\.(jsonl|txt)\Z", "push": "true", **o}, book_pages._parse_datatype_string(book_pages.SCHEMAS[o.get("relation", "pages")]))
    monkeypatch.setenv("VARAQ_TEST_LOG", str(log))
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, Not, StringContains

    r = reader()
    left = list(r.pushFilters([EqualTo(("book",), "a"), In(("page",), (3, 9, 50)), GreaterThan(("page",), 3), Not(EqualTo(("page",), 9)), StringContains(("error",), "x")]))
    assert [type(f).__name__ for f in left] == ["Not", "StringContains"]
    parts = r.partitions()
    assert [x.book for p in parts for x in p.items] == ["a"]
    got = [b.to_pylist() for p in parts for b in r.read(p)]
    assert [x["page"] for b in got for x in b] == [9] and log.read_text() == "9 1 1\n"
    log.write_text("")
    r = reader(relation="words")
    assert list(r.pushFilters([EqualTo(("book",), "b"), LessThanOrEqual(("page",), 2)])) == []
    assert sum(b.num_rows for p in r.partitions() for b in r.read(p)) == 2 and log.read_text() == "1 1 0\n2 1 0\n"
    log.write_text("")
    slim = book_pages.BookPagesReader({"path": folder + "/b.jsonl", "opener": "tests.test_book_pages:open_counting", "suffix": "jsonl"}, book_pages._parse_datatype_string(book_pages.page_columns("book", "page", "page_w")))
    assert sum(b.num_rows for p in slim.partitions() for b in slim.read(p)) == 3 and log.read_text().split("\n")[0] == "1 0 0"
    assert load(spark, folder, schema=book_pages.page_columns("book", "page", "page_w")).columns == ["book", "page", "page_w"]


def test_filters_and_options_reach_the_source(spark, folder):
    df = load(spark, folder, push="true").where("book = 'a' and page between 5 and 6 and length(error) is null")
    assert sorted(r.page for r in df.select("page").collect()) == [5, 6]
    assert load(spark, folder, push="true").where("page <=> 2 and book in ('b', 'bad')").count() == 2
    assert load(spark, folder).where("book = 'b' and book = 'a'").count() == 0
    some = book_pages.read_pages(spark, folder, "words", books=["b", "ب"], first=2, last=7, opener="lines")
    assert sorted((r.book, r.page) for r in some.collect()) == [("b", 2), ("b", 3), ("ب", 7)]
    assert book_pages.read_pages(spark, folder, columns=("page",), first=40, opener="lines").collect() == [(40,)]


def test_a_frame_can_be_used_with_several_filters(spark, folder):
    """Spark keeps filters that it has pushed to a Python source; without the option none is taken."""
    df = load(spark, folder)
    assert df.where("book = 'a'").count() == 40 and df.where("book = 'b'").count() == 3 and df.where("page = 0").count() == 1


def test_too_many_pages_and_pages_of_the_library(spark, folder, tmp_path, monkeypatch):
    one = load(spark, folder, max_pages="3").where("book = 'a'").collect()
    assert [(r.page, r.error) for r in one] == [(0, "PDF has too many pages: 40. Max allowed: 3")]
    closed = []

    class Page:
        width, height = 600, 800

        def __init__(self, k):
            self.k = k

        def extract_words(self, **_):
            if self.k == 1:
                raise RuntimeError("bad font")
            return [{"text": "x", "x0": 1, "x1": 2, "top": 3, "bottom": 4, "size": 12, "fontname": "f", "non_stroking_color": 0}]

        def find_tables(self):
            if self.k == 2:
                raise RuntimeError("no lines")
            return []

        def close(self):
            closed.append(self.k)

    monkeypatch.setitem(sys.modules, "pdfplumber", N(open=lambda f: N(pages=[Page(k) for k in range(3)])))
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.PDF").write_bytes(b"%PDF-")
    r = book_pages.BookPagesReader({"path": f"file://{tmp_path}/p"}, book_pages._parse_datatype_string(book_pages.SCHEMAS["pages"]))
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert [(x["book"], x["page"], x["error"], x["structure_error"], len(x["words"] or ())) for x in rows] == [("x", 1, None, None, 1), ("x", 2, "bad font", None, 0), ("x", 3, None, "no lines", 1)]
    assert closed == [0, 1, 2]


def test_pages_without_readable_words_go_on_to_recognition(spark, folder):
    got = load(spark, folder).where("book = 'bad'").persist()
    text = "متن بازیابی شده از تصویر صفحه دوم کتاب"
    asked = []

    def recognise(short):
        asked.extend(sorted(r.page for r in short.collect()))
        return spark.createDataFrame([("bad", 2, text, 90.0, None), ("bad", 3, None, None, "engine stopped")], adapters.OCR)

    names = spark.createDataFrame([("bad", "bad.pdf", None, None, None)], "book string, filename string, title string, course string, grade string")
    cells = spark.createDataFrame([], "book string, page int, table_no int, row_no int, col_no int, text string, top double, table_x0 double, table_top double, table_x1 double, table_bottom double, page_w double, page_h double")
    lib = engine.run(engine.Library(names, adapters.words_of(got), cells, recognise, listed=adapters.listed(got)), engine.STAGES[:2])
    rows = {r.page: r for r in lib["pages"].collect()}
    assert asked == [1, 2, 3, 4]
    assert (rows[2].method, rows[2].text, rows[2].warnings) == ("ocr_tesseract", text, ["LOW_TEXT_MAY_NEED_OCR", "RECOVERED_VIA_OCR"])
    assert (rows[3].method, rows[3].needs_review, rows[3].warnings) == ("empty", True, ["LOW_TEXT_MAY_NEED_OCR", "OCR_FAILED: engine stopped"])
    assert rows[1].method == "pdfplumber_positional" and lib["counts"].first().ocr_pages == 1
    none = page_ops.page_status(spark.createDataFrame([("b", 1, "x" * 40, None, "no text"), ("b", 2, "x" * 40, "no words", None)], "book string, page int, text string, error string, text_error string"), spark.createDataFrame([], adapters.OCR))
    assert {r.page: (r.method, r.text, r.warnings) for r in none.collect()} == {1: ("failed", "", ["PAGE_EXTRACTION_FAILED: no text"]), 2: ("empty", "", ["LOW_TEXT_MAY_NEED_OCR"])}
    lib.release()
    got.unpersist()

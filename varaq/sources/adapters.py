"""Seams for what Spark cannot do itself: reading PDF files, recognising page images, asking an extractor.

Each takes a plain function and runs it in mapInPandas; a row that fails becomes a row with an error, so one book
does not stop the others. The functions are made once a partition by a factory, so that clients are shared there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.config import SETTINGS

OCR = "book string, page int, text string, confidence double, error string"
RESPONSES = "book string, lesson_order int, response string, error string"


#: A row a page: what its words and cells are, or what went wrong; page 0 stands for the whole file.
PAGES = (
    "book string, page int, page_w double, page_h double, error string, structure_error string, "
    "words array<struct<word_no: int, text: string, x0: double, x1: double, top: double, bottom: double, size: double, fontname: string, color: array<double>>>, "
    "boxes array<struct<table_no: int, row_no: int, col_no: int, x0: double, top: double, x1: double, bottom: double, table_x0: double, table_top: double, table_x1: double, table_bottom: double>>"
)
_PAGE_KEYS = ("page_w", "page_h", "words", "boxes", "structure_error")

#: A reader makes, from a file's bytes, the number of its pages and a function that reads the page of a number.
Opened = tuple[int, Callable[[int], dict]]


def pages_from_files(files: DataFrame, reader: Callable[[], Callable[[bytes], Opened]], max_pages: int = SETTINGS.max_pages) -> DataFrame:
    """files: book, content. A page that fails is a row with an error and does not stop its book; a file that cannot be
    opened or has too many pages is one row for page 0. Pages are handed on one at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = reader()
        columns = ["book", "page", "page_w", "page_h", "error", "structure_error", "words", "boxes"]

        def row(book, page, error=None, got=None):
            return pd.DataFrame([{"book": book, "page": page, "error": error, **{k: (got or {}).get(k) for k in _PAGE_KEYS}}], columns=columns)

        for pdf in batches:
            for book, content in zip(pdf["book"], pdf["content"], strict=True):
                try:
                    count, read = opened(bytes(content))
                    if count > max_pages:
                        raise ValueError(f"PDF has too many pages: {count}. Max allowed: {max_pages}")
                except Exception as e:
                    yield row(book, 0, str(e))
                    continue
                for page in range(1, count + 1):
                    try:
                        yield row(book, page, got=read(page))
                    except Exception as e:
                        yield row(book, page, str(e))

    return files.select("book", "content").mapInPandas(run, PAGES)


def words_of(pages: DataFrame) -> DataFrame:
    return pages.where("page > 0").select("book", "page", F.explode("words").alias("w")).select("book", "page", "w.*")


def boxes_of(pages: DataFrame) -> DataFrame:
    return pages.where("page > 0").select("book", "page", "page_w", "page_h", F.explode("boxes").alias("b")).select("book", "page", "b.*", "page_w", "page_h")


def listed(pages: DataFrame) -> DataFrame:
    """The pages as operators.pages.with_all_pages() takes them."""
    return pages.where("page > 0").select("book", "page", "error", "structure_error")


def book_errors(pages: DataFrame) -> DataFrame:
    """book, error of the files that could not be read at all."""
    return pages.where("page = 0").select("book", "error")


def recognised(images: DataFrame, engine: Callable[[], Callable[[bytes], tuple[str, float | None]]]) -> DataFrame:
    """images: book, page, image, of the pages that need it only. engine makes a function to text and confidence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recognise = engine()
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                try:
                    text, confidence = recognise(bytes(r.image))
                    rows.append((r.book, r.page, text, confidence, None))
                except Exception as e:
                    rows.append((r.book, r.page, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["book", "page", "text", "confidence", "error"])

    return images.select("book", "page", "image").mapInPandas(run, OCR)


def extracted(prompts: DataFrame, extractor: Callable[[], Callable[[str], str | None]]) -> DataFrame:
    """prompts: book, lesson_order, prompt. extractor makes a function from a prompt to a JSON answer or None."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = extractor()
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                try:
                    rows.append((r.book, r.lesson_order, ask(r.prompt), None))
                except Exception as e:
                    rows.append((r.book, r.lesson_order, None, str(e)))
            yield pd.DataFrame(rows, columns=["book", "lesson_order", "response", "error"])

    return prompts.select("book", "lesson_order", "prompt").mapInPandas(run, RESPONSES)


def page_words(page) -> Iterator[dict]:
    """The words of a page of pdfplumber."""

    def numbers(color) -> list[float] | None:
        return None if color is None else [float(x) for x in (color if isinstance(color, (list, tuple)) else [color])]

    for k, w in enumerate(page.extract_words(use_text_flow=False, extra_attrs=["size", "non_stroking_color", "fontname"])):
        yield {"word_no": k, "color": numbers(w.get("non_stroking_color")), **{c: w.get(c) for c in ("text", "x0", "x1", "top", "bottom", "size", "fontname")}}


def page_boxes(page) -> Iterator[dict]:
    """The cells of the bordered regions of a page of pdfplumber."""
    for n, table in enumerate(page.find_tables(), 1):
        outer = dict(zip(("table_x0", "table_top", "table_x1", "table_bottom"), map(float, table.bbox), strict=True))
        for i, line in enumerate(table.rows, 1):
            for j, cell in enumerate(line.cells, 1):
                inner = zip(("x0", "top", "x1", "bottom"), map(float, cell) if cell else (None,) * 4, strict=True)
                yield {"table_no": n, "row_no": i, "col_no": j, **dict(inner), **outer}


def pdf_reader() -> Callable[[bytes], Opened]:
    """Words and bordered regions of the pages of a PDF whose content is in a row; sources.book_pages reads files."""
    import io

    from varaq.sources.book_pages import open_pdf

    open_book = open_pdf()

    def opened(content: bytes) -> Opened:
        book = open_book(io.BytesIO(content))

        def read(number: int) -> dict:
            got = book.read(number, True, True)
            if "error" in got:
                raise ValueError(got["error"])
            return {"boxes": [], **got}

        return len(book.numbers), read

    return opened

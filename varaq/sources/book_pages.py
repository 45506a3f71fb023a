"""Books as a data source of pages: spark.read.format("book_pages").load(folder), after register(spark).

A large file is dealt to several tasks, each of which opens it (at random access) and reads its own range of pages; small
files share a task. Some books, or a range of pages, can be asked for: files of other books and other pages are not opened. What
is not asked for is not read: take the relation `words` or `boxes`, or name the columns of `pages` with .schema(...). A page's
memory is freed before the next one is read. read_pages() sets the options.

Options
    books        a JSON list of names
    first_page, last_page
    push         true: filters on book and page are applied by the source as well. Spark 4.1 keeps what it has pushed to a
                 Python source for all later uses of the same frame, so set it on frames that one query uses only
    relation     pages (default; a row a page, as sources.adapters.PAGES), words or boxes (a row each)
    opener       pdf (default, with the library pdfplumber), lines (a page a line, as JSON), or module:function
    split_bytes  bytes of a file, or of small files together, for one task; 16 MB
    max_pages    a book with more is an error

An opener makes a function from a seekable binary file to a Book. A page that cannot be read is a row with an error, also
where only its words or only its boxes cannot; a file that cannot be opened, or has too many pages, is one row for page 0
(in `words` and `boxes` such pages and files have no rows). A file below a folder `book=<name>` belongs to that book,
as partitioned writes lay them out; any other is a book of its own.
"""

from __future__ import annotations

import gzip
import importlib
import io
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any, BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import json as arrow_json
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType, _parse_datatype_string

from varaq.config import SETTINGS
from varaq.sources.adapters import PAGES

_WORD = "word_no int, text string, x0 double, x1 double, top double, bottom double, size double, fontname string, color array<double>"
_BOX = "table_no int, row_no int, col_no int, x0 double, top double, x1 double, bottom double, table_x0 double, table_top double, table_x1 double, table_bottom double"
SCHEMAS = {"pages": PAGES, "words": f"book string, page int, {_WORD}", "boxes": f"book string, page int, page_w double, page_h double, {_BOX}"}
SPLIT_BYTES = 16 << 20
#: Bytes of JSON lines whose words are read at once.
_AT_ONCE = 4 << 20


@dataclass
class Book:
    """An open book: the numbers of its pages, ascending, and what reads one of them.

    read(number, words, boxes) gives page_w, page_h and, as far as asked for, words and boxes (lists of dicts) and
    structure_error (the boxes could not be read).
    """

    numbers: Sequence[int]
    read: Callable[[int, bool, bool], dict]
    close: Callable[[], None] = lambda: None
    #: The JSON line of a page, where pages are that.
    line: Callable[[int], bytes] | None = None


Opener = Callable[[], Callable[[BinaryIO], Book]]


def _said(e: Exception) -> str:
    return str(e) or type(e).__name__


def open_lines() -> Callable[[BinaryIO], Book]:
    """Books that another tool has taken apart: a line a page, {"page": n, "page_w":, "page_h":, "words": [...], "boxes":
    [...]}, in any order, compressed by gzip or not. Only the places of the lines are kept in memory."""

    def opened(file: BinaryIO) -> Book:
        if file.read(2) == b"\x1f\x8b":
            file.seek(0)
            file = gzip.GzipFile(fileobj=file)
        file.seek(0)
        places, at = {}, 0
        for line in file:
            m = re.match(rb'\s*\{\s*"page"\s*:\s*(\d+)', line)
            if not m:
                raise ValueError(f"line {len(places) + 1} does not begin with its page")
            places[int(m.group(1))] = at
            at += len(line)

        def line_of(number: int) -> bytes:
            file.seek(places[number])
            return file.readline()

        return Book(sorted(places), lambda number, words, boxes: json.loads(line_of(number)), line=line_of)

    return opened


def open_pdf() -> Callable[[BinaryIO], Book]:
    """Words and bordered regions of the pages of a PDF, by the optional library pdfplumber."""
    try:
        import pdfplumber
    except ImportError as e:
        raise RuntimeError("reading PDF files needs the library pdfplumber") from e
    from varaq.sources.adapters import page_boxes, page_words

    def opened(file: BinaryIO) -> Book:
        book = pdfplumber.open(file)

        def read(number: int, words: bool, boxes: bool) -> dict:
            page = book.pages[number - 1]
            out: dict[str, Any] = {"page_w": float(page.width or 0), "page_h": float(page.height or 0)}
            try:
                if words:
                    try:
                        out["words"] = list(page_words(page))
                    except Exception as e:  # recognition may still read it
                        out["error"] = _said(e)
                if boxes:
                    try:
                        out["boxes"] = list(page_boxes(page))
                    except Exception as e:  # the page's lines still count
                        out["structure_error"] = _said(e)
            finally:
                getattr(page, "close", lambda: None)()
            return out

        return Book(range(1, len(book.pages) + 1), read, getattr(book, "close", lambda: None))

    return opened


OPENERS: dict[str, Opener] = {"pdf": open_pdf, "lines": open_lines}
_SUFFIX = {"pdf": r"(?i)\.pdf\Z", "lines": r"\.(jsonl|txt)(\.gz)?\Z"}


def _words_of_lines(lines: list[bytes], book: str, numbers: list[int], schema: pa.Schema) -> pa.RecordBatch | None:
    """The words of some pages' JSON lines, column by column; None where the lines hold anything but plain words, so that
    each page must be looked at."""
    data = b"".join(x if x.endswith(b"\n") else x + b"\n" for x in lines)
    own = [f for f in schema if f.name not in ("book", "page")]
    if data.count(b'"page"') != len(lines) or b'"book"' in data:  # words have pages or books of their own
        return None
    fields = pa.schema([*own, pa.field("words", pa.list_(pa.struct(own)))])  # a page's own values hold for words that lack them
    try:
        read = arrow_json.ReadOptions(use_threads=False, block_size=len(data) + 1)
        t = arrow_json.read_json(io.BytesIO(data), read, arrow_json.ParseOptions(explicit_schema=fields, unexpected_field_behavior="ignore"))
        t = t.combine_chunks()
        if t.num_rows != len(lines) or any(t[f.name].null_count < len(lines) for f in own):
            return None
        listed = t["words"].chunk(0)
        words, page = pc.list_flatten(listed), pa.array(numbers, pa.int32()).take(pc.list_parent_indices(listed))
        if words.null_count:
            return None
        columns = {"book": pa.repeat(book, len(words)), "page": page, **dict(zip((f.name for f in own), words.flatten(), strict=True))}
        batch = pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
        batch.validate(full=True)
        return batch
    except (pa.ArrowException, ValueError):
        return None


def _opener(name: str) -> Opener:
    if name in OPENERS:
        return OPENERS[name]
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


@dataclass
class Range:
    """Part `part` of `parts` of a file."""

    book: str
    path: str
    part: int
    parts: int


@dataclass
class Ranges(InputPartition):
    """What one task reads."""

    items: list[Range]

    def __init__(self, items: list[Range]):
        super().__init__(None)
        self.items = items


@dataclass
class Wanted:
    """Pages that pushed filters leave: between low and high and, if there are sets, in all of them."""

    low: int = -(2**31)
    high: int = 2**31
    sets: list[set] = field(default_factory=list)

    def __contains__(self, page: int) -> bool:
        return self.low <= page <= self.high and all(page in s for s in self.sets)

    def push(self, f: Filter) -> bool:
        """Take a filter on the page; False if it is of another kind."""
        if isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
            self.sets.append({f.value})
        elif isinstance(f, In):
            self.sets.append(set(f.value))
        elif isinstance(f, GreaterThan):
            self.low = max(self.low, f.value + 1)
        elif isinstance(f, GreaterThanOrEqual):
            self.low = max(self.low, f.value)
        elif isinstance(f, LessThan):
            self.high = min(self.high, f.value - 1)
        elif isinstance(f, LessThanOrEqual):
            self.high = min(self.high, f.value)
        else:
            return False
        return True


def _filesystem(path: str):
    """The store of a path or URI as Spark gives it (not percent-encoded), and the path there."""
    from pyarrow import fs

    m = re.match(r"([a-z0-9+.-]+):(?://([^/]*))?(/.*)\Z", path, re.S)
    if not m or m.group(1) == "file":
        return fs.LocalFileSystem(), m.group(3) if m else path
    return fs.FileSystem.from_uri(f"{m.group(1)}://{m.group(2) or ''}{quote(m.group(3))}")


def _book_of(path: str) -> str:
    inner = re.search(r"/book=([^/]*)/[^/]*\Z", path)
    return unquote(inner.group(1)) if inner else re.sub(r"(?<=.)\.[^.]*(\.gz)?\Z", "", path.rsplit("/", 1)[-1])


def _together(book: Book, numbers: list[int]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pages and their lines, as many as are read at once."""
    some, lines, size = [], [], 0
    for k in numbers:
        line = book.line(k)
        if some and size + len(line) > _AT_ONCE:
            yield some, lines
            some, lines, size = [], [], 0
        some.append(k)
        lines.append(line)
        size += len(line)
    if some:
        yield some, lines


class BookPagesReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.schema, self.options = schema, {k.lower(): v for k, v in options.items()}
        self.relation = self.options.get("relation", "pages")
        self.pages = Wanted(int(self.options.get("first_page", -(2**31))), int(self.options.get("last_page", 2**31)))
        self.books = set(json.loads(self.options["books"])) if "books" in self.options else None

    def pushFilters(self, filters):
        if self.options.get("push", "false").lower() != "true":
            yield from filters
            return
        for f in filters:
            on = getattr(f, "attribute", None)
            if on == ("page",) and self.pages.push(f):
                continue
            if on == ("book",) and (isinstance(f, EqualTo) or isinstance(f, In)):
                names = set(f.value) if isinstance(f, In) else {f.value}
                self.books = names if self.books is None else self.books & names
                continue
            yield f  # Spark applies it

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _filesystem(self.options["path"])
        limit = int(self.options.get("split_bytes", SPLIT_BYTES))
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
        suffix = re.compile(self.options.get("suffix", _SUFFIX.get(self.options.get("opener", "pdf"), "")))
        kept = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and suffix.search(f.path) and not re.search(r"/[_.][^/]*\Z", f.path))
        out, small, size = [], [], 0
        for path, length in kept:
            book = _book_of(path)
            if self.books is not None and book not in self.books:
                continue
            parts = max(1, -(-length // limit))
            if parts > 1:
                out += [Ranges([Range(book, path, k, parts)]) for k in range(parts)]
                continue
            if small and size + length > limit:
                out.append(Ranges(small))
                small, size = [], 0
            small.append(Range(book, path, 0, 1))
            size += length
        return out + ([Ranges(small)] if small else [])

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        if partition is None:
            return
        store, _ = _filesystem(self.options["path"])
        opened = _opener(self.options.get("opener", "pdf"))()
        for item in partition.items:
            for row in self._pages(store, opened, item, schema):
                if isinstance(row, pa.RecordBatch):
                    yield row
                    continue
                rows = [row] if self.relation == "pages" else [{**row, **x} for x in row.get(self.relation) or ()]
                if rows:
                    yield self._batch(rows, schema, row)

    def _batch(self, rows: list[dict], schema: pa.Schema, row: dict) -> pa.RecordBatch:
        try:
            return pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in schema} for r in rows], schema=schema)
        except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError) as e:  # a value of the wrong kind
            bad = {"book": row["book"], "page": row["page"], "error": str(e)}
            return pa.RecordBatch.from_pylist([{f.name: bad.get(f.name) for f in schema}] if self.relation == "pages" else [], schema=schema)

    def _pages(self, store, opened, item: Range, schema: pa.Schema) -> Iterator[dict | pa.RecordBatch]:
        """The pages of a range as rows: what could be read, or an error. Plain words come many pages at once."""
        names = set(self.schema.names)
        words = self.relation == "words" or self.relation == "pages" and bool(names & {"words", "error"})
        boxes = self.relation == "boxes" or self.relation == "pages" and bool(names & {"boxes", "structure_error"})
        most = int(self.options.get("max_pages", SETTINGS.max_pages))
        with io.BufferedReader(store.open_input_file(item.path), 1 << 20) as file:
            try:
                book = opened(file)
                n = len(book.numbers)
                if n > most:
                    raise ValueError(f"PDF has too many pages: {n}. Max allowed: {most}")
            except Exception as e:
                if item.part == 0 and self.relation == "pages" and 0 in self.pages:
                    yield {"book": item.book, "page": 0, "error": _said(e)}
                return
            mine = book.numbers[n * item.part // item.parts : n * (item.part + 1) // item.parts]
            asked = [k for k in mine[bisect_left(mine, self.pages.low) : bisect_right(mine, self.pages.high)] if k in self.pages]
            try:
                for numbers, lines in _together(book, asked) if self.relation == "words" and book.line else (([k], []) for k in asked):
                    batch = _words_of_lines(lines, item.book, numbers, schema) if lines else None
                    if batch is not None:
                        yield batch
                        continue
                    for number in numbers:
                        try:
                            got = book.read(number, words, boxes)
                        except Exception as e:
                            got = {"error": _said(e)}
                        yield {**got, "book": item.book, "page": number}
            finally:
                book.close()


class BookPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "book_pages"

    def schema(self) -> str:
        relation = {k.lower(): v for k, v in self.options.items()}.get("relation", "pages")
        if relation not in SCHEMAS:
            raise ValueError(f"no relation {relation}; there are {', '.join(SCHEMAS)}")
        return SCHEMAS[relation]

    def reader(self, schema: StructType) -> DataSourceReader:
        return BookPagesReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed down to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BookPages)


def read_pages(spark: SparkSession, folder: str, relation: str = "pages", books: list[str] | None = None, first: int | None = None, last: int | None = None, columns: tuple[str, ...] = (), **options):
    """A relation of the books below a folder: of some books, of pages first to last, of some columns (pages only)."""
    register(spark)
    asked = {"relation": relation, "books": None if books is None else json.dumps(books), "first_page": first, "last_page": last, **options}
    r = spark.read.format("book_pages").options(**{k: str(v) for k, v in asked.items() if v is not None})
    return (r.schema(page_columns(*columns)) if columns else r).load(folder)


def page_columns(*names: str) -> str:
    """A schema of some columns of `pages`, for .schema(...)."""
    kinds = {f.name: f.dataType.simpleString() for f in _parse_datatype_string(PAGES)}
    return ", ".join(f"{n} {kinds[n]}" for n in names)

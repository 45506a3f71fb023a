"""Words of JSON lines are read many pages at once, and page by page where lines hold anything else; rows are the same."""

import json

import pyarrow as pa
from pyspark.sql.types import _parse_datatype_string

from varaq.sources import book_pages

WORD = {"word_no": 1, "text": 'کتاب "page" \\ x', "x0": 1.5, "x1": 2, "top": 0.0, "bottom": 9.0, "size": None, "fontname": "N", "color": [0.5, 0]}
ODD = (
    [{**WORD, "page": 77}], [{**WORD, "book": "other"}], [{**WORD, "x0": "wide"}], [{**WORD, "word_no": 1.5}], [{**WORD, "color": 3}], [{**WORD, "text": 5}], [{**WORD, "further": {"a": [1]}}],
    [{"text": "x"}], [], None, [WORD] * 3,
)


def rows(folder, at_once, monkeypatch):
    """What the reader gives, and how often it gave words of many pages at once."""
    calls, whole = [], book_pages._words_of_lines

    def told(*a):
        got = whole(*a) if at_once else None
        calls.append(got is not None)
        return got

    monkeypatch.setattr(book_pages, "_words_of_lines", told)
    reader = book_pages.BookPagesReader({"path": str(folder), "relation": "words", "opener": "lines"}, _parse_datatype_string(book_pages.SCHEMAS["words"]))
    got = [x for p in reader.partitions() for b in reader.read(p) for x in b.to_pylist()]
    monkeypatch.setattr(book_pages, "_words_of_lines", whole)
    return sorted(map(str, got)), sum(calls)


def test_rows_are_those_of_single_pages(spark, tmp_path, monkeypatch):
    for k, odd in enumerate(ODD):
        folder = tmp_path / str(k)
        folder.mkdir()
        pages = [{"page": 1, "words": [WORD]}, {"page": 3, "page_w": 5, "words": odd}, {"page": 2, "words": [WORD, {**WORD, "text": None}]}]
        (folder / "b.jsonl").write_text("\n".join(json.dumps(p, ensure_ascii=k % 2 == 0) for p in pages), encoding="utf-8")
        assert rows(folder, True, monkeypatch)[0] == rows(folder, False, monkeypatch)[0], odd


def test_values_of_pages_broken_lines_and_bytes_that_are_no_text(spark, tmp_path, monkeypatch):
    one = json.dumps({"page": 1, "words": [WORD]}).encode()
    for k, line in enumerate((b'{"page": 2, "size": 4.5, "words": [{"text": "x"}]}', b'{"page": 2, "words": [', b'{"page": 2, "words": [{"text": "\xff"}]}', b'{"page": 2, "words": [{"x0": NaN}]}', b'{"page": 2, "words": [], "words": [{"text": "y"}]}')):
        folder = tmp_path / str(k)
        folder.mkdir()
        (folder / "b.jsonl").write_bytes(one + b"\n" + line + b"\n")
        assert rows(folder, True, monkeypatch)[0] == rows(folder, False, monkeypatch)[0], line


def test_plain_words_come_many_pages_at_once(spark, tmp_path, monkeypatch):
    """Of 500 pages without anything odd, none is looked at by itself."""
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps({"page": k, "words": [WORD] * 40}) for k in range(500)))
    monkeypatch.setattr(book_pages.BookPagesReader, "_batch", lambda *a: 1 / 0)
    got, calls = rows(tmp_path, True, monkeypatch)
    assert len(got) == 20_000 and calls == 1
    assert isinstance(book_pages._words_of_lines([b'{"page": 1, "words": [{"text": "x"}]}'], "b", [1], pa.schema([("book", pa.string()), ("page", pa.int32()), ("text", pa.string())])), pa.RecordBatch)

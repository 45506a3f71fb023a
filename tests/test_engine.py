"""The whole chain over a small library, sources, adapters, jobs and streams."""

import json

import pytest
from pyspark.sql import functions as F

from varaq.operators import graph, jobs, lessons, outline, tables
from varaq.plans import engine
from varaq.sources import adapters, books
from varaq.streaming import jobs as streams

WORDS = "book string, page int, word_no int, text string, x0 double, x1 double, top double, bottom double, size double, fontname string, color array<double>"
CELLS = "book string, page int, table_no int, row_no int, col_no int, text string, top double, table_x0 double, table_top double, table_x1 double, table_bottom double, page_w double, page_h double"
OCR = "book string, page int, text string, confidence double, error string"


def page(book, number, lines, size=12.0):
    """Words of lines, as a PDF stores them: left to right, letters of Persian words mirrored."""
    out, k = [], 0
    for at, (line, s) in enumerate((x, size) if isinstance(x, str) else x for x in lines):
        for j, w in enumerate(line.split(" ")):
            mirrored = w if w.strip(".,:").isdigit() else w[::-1] if any("؀" <= c <= "ۿ" for c in w) else w
            out.append((book, number, k, mirrored, 500.0 - 20 * j, 515.0 - 20 * j, 20.0 * at, 20.0 * at + 10, s, None, None))
            k += 1
    return out


@pytest.fixture(scope="module")
def library(spark):
    rows = page("b", 1, [("فهرست", 30.0), "فصل اول: جامعه .... 1", "درس اول: کنش ..... 2", "پرسش ها ... 2", "های", "درس دوم : ما ...... 3"])
    rows += page("b", 2, [("فصل اول جامعه", 30.0), "این متن بدنه کتاب است و باید کافی باشد", "ادامه همان بند"])
    rows += page("b", 3, [("درس اول کنش", 30.0), "متن درس اول که به اندازه کافی بلند است"])
    rows += page("b", 4, [("درس دوم ما", 30.0), "متن درس دوم که به اندازه کافی بلند است", "متن جدول"])
    rows += page("b", 5, ["کوتاه"])
    rows += page("c", 1, ["متن کتاب دوم بدون فهرست ولی با متن کافی"])
    cells = [("b", 4, 1, r, c, f"r{r}|c{c}" if (r, c) != (2, 2) else "", 40.0, 0.0, 39.0, 100.0, 51.0, 600.0, 800.0) for r in (1, 2) for c in (1, 2)]
    ocr = [("b", 5, "متن بازیابی شده از تصویر صفحه پنجم کتاب", 40.25, None)]
    asked = [("b", "b.pdf", "کتاب", None, "11"), ("c", "c.pdf", None, "x", None)]
    lib = engine.Library(spark.createDataFrame(asked, "book string, filename string, title string, course string, grade string"), spark.createDataFrame(rows, WORDS), spark.createDataFrame(cells, CELLS), spark.createDataFrame(ocr, OCR))
    seen = []
    engine.run(lib, progress=seen.append)
    assert seen == [n for n, _ in engine.STAGES]
    return lib


def test_lines_blocks_and_pages(library):
    blocks = {(r.page, r.block_index): (r.type, r.text) for r in library["blocks"].where("book = 'b'").collect()}
    assert blocks[2, 1] == ("heading", "فصل اول جامعه")
    assert blocks[2, 2] == ("paragraph", "این متن بدنه کتاب است و باید کافی باشد\nادامه همان بند")
    assert blocks[4, 3] == ("table", "r1|c1 | r1|c2\nr2|c1 | ")
    assert blocks[5, 1] == ("paragraph", "متن بازیابی شده از تصویر صفحه پنجم کتاب")
    pages = {r.page: r for r in library["pages"].where("book = 'b'").collect()}
    assert pages[5].method == "ocr_tesseract" and pages[5].warnings == ["LOW_TEXT_MAY_NEED_OCR", "OCR_LOW_CONFIDENCE:40.2", "RECOVERED_VIA_OCR"]
    assert "متن جدول" in pages[4].text  # page text keeps what tables hold
    assert not pages[2].needs_review


def test_outline_and_lessons(library):
    rows = [(r.role, r.order, r.title, r.page) for r in library["outline"].orderBy("seq").collect()]
    assert rows == [("chapter", 1, "جامعه", 1), ("lesson", 1, "کنش", 2), ("subtopic", None, "پرسش ها", 2), ("lesson", 2, "های ما", 3)]
    got = [(r.order, r.start_page, r.end_page) for r in library["lessons"].orderBy("seq").collect()]
    assert got == [(1, 3, 3), (2, 4, 5)]
    seed = json.loads(library["seed"].first().json)
    assert seed["field"] is None and seed["chapters"][0]["lessons"][0]["subtopics"] == [{"title": "پرسش ها", "page": 2}]


def test_exports(library, tmp_path):
    from varaq.operators.render import write_each

    docs = {r.book: json.loads(r.json) for r in library["json"].collect()}
    assert docs["b"]["metadata"]["filename"] == "b.pdf" and len(docs["b"]["pages"]) == 5 and docs["c"]["metadata"]["title"] is None
    md = {r.book: r.markdown for r in library["markdown"].collect()}
    assert md["b"].startswith("# کتاب\n\n- فایل: b.pdf\n- درس: -\n") and "| r1\\|c1 | r1\\|c2 |\n| --- | --- |" in md["b"] and md["c"].startswith("# c\n")
    assert write_each(library["markdown"], f"file://{tmp_path}/md", "markdown", ".md") == 2
    assert (tmp_path / "md" / "b.md").read_text(encoding="utf-8").rstrip("\n") == md["b"].rstrip("\n") and sorted(f.name for f in (tmp_path / "md").iterdir() if f.suffix == ".md") == ["b.md", "c.md"]
    assert set(docs["b"]) == {"metadata", "pages", "blocks", "warnings", "processing_version"} and docs["b"]["blocks"] == []
    assert docs["b"]["metadata"] == {"filename": "b.pdf", "title": "کتاب", "course": None, "grade": "11", "language": "fa", "total_pages": 5}
    page = docs["b"]["pages"][3]
    assert set(page) == {"page_number", "text", "char_count", "extraction_method", "needs_review", "warnings", "blocks"}
    assert [x["id"] for x in page["blocks"]] == ["4-1", "4-2", "4-3"]
    heading, plain, grid = page["blocks"]
    assert heading == {"id": "4-1", "type": "heading", "text": "درس دوم ما", "page": 4, "source": None, "metadata": {"confidence": 0.5, "reason": "size_ratio=2.50"}}
    assert plain["metadata"] == {}
    assert grid["metadata"] == {"rows": [["r1|c1", "r1|c2"], ["r2|c1", ""]], "fill_ratio": 0.75, "top": 40.0, "confidence": 0.75, "source": "bordered_region"}
    assert docs["b"]["pages"][4]["blocks"][0]["metadata"] == {"source": "ocr_fallback"}
    assert library["lines"].is_cached and library["blocks"].is_cached
    rows = {r.book: r for r in engine.summary(library, "/out").collect()}
    assert rows["c"].chapters == 0 and rows["c"].seed_path is None and rows["b"].seed_path == "/out/seed/b.seed.json" and rows["b"].ok and rows["b"].warnings == []


def test_graph_keeps_bad_lessons_out(spark, library):
    answers = [
        ("b", 1, json.dumps({"concepts": [{"id": "a", "title": "A", "confidence_score": 0}, {"id": "b", "title": "B"}, {"id": "", "title": "x"}], "relationships": [{"source_concept_id": "a", "target_concept_id": "z", "relation_type": "related"}, {"source_concept_id": "a", "target_concept_id": "b", "relation_type": "cause"}, {"source_concept_id": "a", "target_concept_id": "b", "relation_type": "parent"}]})),
        ("b", 2, json.dumps({"concepts": [{"id": "a", "title": "A", "confidence_score": 1.5}]})),
        ("b", 3, None),
        ("b", 4, "not json"),
    ]
    lib = engine.with_graph(library, spark.createDataFrame(answers, "book string, lesson_order int, response string"))
    assert [(r.id, r.confidence) for r in lib["concepts"].orderBy("pos").collect()] == [("lesson-1:a", 0.7), ("lesson-1:b", 0.7)]
    assert [(r.id, r.type) for r in lib["relationships"].collect()] == [("lesson-1:rel-3", "parent")]
    assert lib["failed_lessons"].count() == 1
    assert graph.edges_of(lib["relationships"], "lesson-1:b").count() == 1
    doc = json.loads(lib["graph"].first().json)
    assert set(doc) == {"book_title", "course", "grade", "version", "concepts", "relationships"} and doc["version"] == 1 and doc["book_title"] == "کتاب"
    one = doc["concepts"][0]
    assert one == {
        "id": "lesson-1:a", "title": "A", "definition": None, "explanation": None, "examples": [], "common_misconceptions": [], "socratic_questions": [], "version": 1, "confidence_score": 0.7,
        "source_refs": [{"filename": "b.pdf", "page": 3, "block_id": None}],
    }
    assert doc["relationships"] == [{"id": "lesson-1:rel-3", "source_concept_id": "lesson-1:a", "target_concept_id": "lesson-1:b", "relation_type": "parent", "confidence_score": 1.0, "source_refs": one["source_refs"], "notes": None}]
    assert engine.summary(lib, "/out").where("book = 'b'").first().graph_path == "/out/graph/b.graph.json"


def test_cancel_stops_before_a_stage(library):
    with pytest.raises(engine.Cancelled):
        engine.run(library, cancelled=lambda: True)


def test_mode_takes_the_first_seen_of_equals(spark):
    o = [("b", k, "lesson", k, f"t{k}", p, 0, k) for k, p in ((1, 1), (2, 2), (3, 10), (4, 11))]
    out = spark.createDataFrame(o, 'book string, seq bigint, role string, `order` int, title string, page bigint, chapter_seq bigint, lesson_seq bigint')
    heads = [("b", 10, 1, "heading", "درس اول"), ("b", 11, 1, "heading", "درس دوم"), ("b", 18, 1, "heading", "درس سوم"), ("b", 19, 1, "heading", "درس چهارم")]
    b = spark.createDataFrame(heads, "book string, page int, block_index int, type string, text string")
    assert lessons.offsets(b, out).first().offset == 9


def test_lesson_before_any_chapter_is_lost(spark):
    lines = ["درس اول: x ... 1", "زیر ... 2", "فصل اول: y ... 3", "تنها ... 4", "درس دوم: z ... 2٩", "زیر دو ... 5", "پایان"]
    t = spark.createDataFrame([("b", 1, k, x) for k, x in enumerate(lines)], "book string, page int, line_no int, line string")
    got = [(r.role, r.title, r.page) for r in outline.outline(outline.toc_entries(t)).orderBy("seq").collect()]
    assert got == [("chapter", "y", 3), ("lesson", "z", 29), ("subtopic", "زیر دو", 5)]
    assert outline.outline(outline.toc_entries(t.limit(0))).count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "a.PDF").write_bytes(b"PK")
    (tmp_path / "c.txt").write_bytes(b"%PDF-")
    (tmp_path / "e.pdf").write_bytes(b"")
    (tmp_path / "b.meta.json").write_text('{\n"book_title": "عنوان",\n"grade": "11"}', encoding="utf-8")
    files = {r.name: r.error for r in books.book_files(spark, f"file://{tmp_path}").collect()}
    assert files == {"a.PDF": "not_a_pdf", "b.meta.json": "unsupported_type", "b.pdf": None, "c.txt": "unsupported_type"}
    assert [r.filename for r in books.discovered(spark, f"file://{tmp_path}").collect()] == ["b.pdf"]
    side = books.sidecars(spark, f"file://{tmp_path}").first()
    assert (side.book, side.book_title, side.course, side.grade) == ("b", "عنوان", None, "11")
    with pytest.raises(ValueError):
        books.chosen(books.discovered(spark, f"file://{tmp_path}"), [])
    assert books.expired_files(spark, f"file://{tmp_path}", 24, F.current_timestamp()).count() == 0
    (tmp_path / "old").mkdir()
    for name in ("x.md", "y.md"):
        (tmp_path / "old" / name).write_text("x")
    old = books.expired_files(spark, f"file://{tmp_path}/old", -1, F.current_timestamp())
    assert books.delete_files(old, ["/elsewhere"]) == 0 and books.delete_files(old, [str(tmp_path)]) == 2 and not list((tmp_path / "old").glob("*.md"))
    assert books.delete_files(spark.createDataFrame([(f"{tmp_path}/b.pdf",), (f"{tmp_path}/old/../../z",), (f"{tmp_path}/old",)], "path string"), [f"{tmp_path}/old"]) == 0


def test_adapters_isolate_failures(spark):
    files = spark.createDataFrame([("good", b"x y|broken|z"), ("bad", b""), ("long", b"a|b|c|d")], "book string, content binary")

    def reader():
        def opened(content):
            if not content:
                raise OSError("cannot open")
            texts = content.decode().split("|")

            def read(number):
                if texts[number - 1] == "broken":
                    raise OSError("bad page")
                words = [{"word_no": k, "text": w, "x0": 10.0 * k, "x1": 10.0 * k + 5, "top": 0.0, "bottom": 1.0} for k, w in enumerate(texts[number - 1].split())]
                box = {"table_no": 1, "row_no": 1, "x0": 0.0, "top": 0.0, "x1": 8.0, "bottom": 9.0, "table_x0": 0.0, "table_top": 0.0, "table_x1": 8.0, "table_bottom": 9.0}
                boxes = [{**box, "col_no": 1}, {**box, "col_no": 2, "x0": None, "top": None, "x1": None, "bottom": None}]
                return {"page_w": 100.0, "page_h": 100.0, "words": words, "boxes": boxes, "structure_error": "no lines" if number == 3 else None}

            return len(texts), read

        return opened

    pages = adapters.pages_from_files(files, reader, max_pages=3).persist()
    assert {(r.book, r.error) for r in adapters.book_errors(pages).collect()} == {("bad", "cannot open"), ("long", "PDF has too many pages: 4. Max allowed: 3")}
    words = adapters.words_of(pages)
    assert [(r.page, r.text) for r in words.orderBy("page", "word_no").collect()] == [(1, "x"), (1, "y"), (3, "z")]
    assert [(r.page, r.error, r.structure_error) for r in adapters.listed(pages).orderBy("page").collect()] == [(1, None, None), (2, "bad page", None), (3, None, "no lines")]
    cells = tables.cells_of(words, adapters.boxes_of(pages)).where("page = 1").orderBy("col_no").collect()
    assert [(r.text, r.top, r.page_w) for r in cells] == [("", 0.0, 100.0), (None, None, 100.0)]  # one letter is noise
    asked = spark.createDataFrame([("good", "good.pdf", None, None, None)], "book string, filename string, title string, course string, grade string")
    lib = engine.run(engine.Library(asked, words, tables.cells_of(words, adapters.boxes_of(pages)), spark.createDataFrame([], OCR), listed=adapters.listed(pages)))
    got = {r.page: (r.method, r.needs_review, r.warnings) for r in lib["pages"].collect()}
    assert got[1] == ("pdfplumber_positional", True, ["LOW_TEXT_MAY_NEED_OCR"]) and got[3][0] == "empty" and got[2] == ("empty", True, ["LOW_TEXT_MAY_NEED_OCR"])  # without words it goes on to recognition
    assert lib["counts"].first().total_pages == 3
    lib.release()
    images = spark.createDataFrame([("b", 1, b"i"), ("b", 2, b"")], "book string, page int, image binary")
    seen = adapters.recognised(images, lambda: lambda i: ("t", 80.0) if i else 1 / 0).orderBy("page").collect()
    assert seen[0].text == "t" and "division" in seen[1].error
    answers = adapters.extracted(spark.createDataFrame([("b", 1, "p")], "book string, lesson_order int, prompt string"), lambda: lambda p: None).first()
    assert answers.response is None and answers.error is None


def test_job_rules(spark):
    with pytest.raises(ValueError):
        jobs.check_update(["state", "user_id"])
    rows = [("a", 1, "queued", None), ("b", 1, "exporting", None), ("c", 2, "queued", None), ("d", 1, "completed", None)]
    j = spark.createDataFrame(rows, "id string, user_id int, state string, completed_at timestamp").withColumn("cancellation_requested", F.lit(False))
    got = {r.id: (r.state, r.changed, r.cancellation_requested) for r in jobs.cancel(j, F.lit(1), F.current_timestamp()).collect()}
    assert got == {"a": ("cancelled", True, True), "b": ("cancel_requested", True, True), "c": ("queued", False, False), "d": ("completed", False, False)}
    assert jobs.expired(j, F.current_timestamp()).count() == 0  # without a time of completion


def test_job_stream(spark, tmp_path):
    rows = [("a", 1, "queued"), ("a", 2, "extracting"), ("b", 1, "queued"), ("a", 3, "completed"), ("a", 4, "queued"), ("b", 1, "failed")]
    for k, part in enumerate((rows[:3], rows[3:])):
        df = spark.createDataFrame(part, "id string, seq bigint, state string").withColumn("at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/events/{k}")
    stream = spark.readStream.schema(streams.EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/events")
    q = streams.lifecycle(stream).writeStream.outputMode("update").format("memory").queryName("job_states").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = {r.id: r.state for r in spark.sql("select id, max_by(state, changes) as state from job_states group by id").collect()}
    assert last == {"a": "completed", "b": "queued"}
    q = streams.arrivals_per_window(stream).writeStream.outputMode("complete").format("memory").queryName("arrivals").option("checkpointLocation", f"file://{tmp_path}/cp2").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select sum(n) as n from arrivals").first().n == len(rows)


class FakePdf:
    """What the optional library gives for one page with a table."""

    class Page:
        width, height = 600, 800

        def __init__(self, broken):
            self.broken = broken

        def extract_words(self, **_):
            line = "متن صفحه که باید به اندازه کافی بلند باشد تا خوانده شود".split()
            return [{"text": w[::-1], "x0": 500 - 40 * k, "x1": 530 - 40 * k, "top": 300, "bottom": 310, "size": 12, "fontname": "f", "non_stroking_color": 0} for k, w in enumerate(line)] + [
                {"text": "ab", "x0": 12, "x1": 20, "top": 12, "bottom": 18, "size": 12, "fontname": "f", "non_stroking_color": (0, 0, 0)}
            ]

        def find_tables(self):
            from types import SimpleNamespace as N

            if self.broken:
                raise RuntimeError("no lines")
            return [N(bbox=(10, 10, 100, 50), rows=[N(cells=[(10, 10, 50, 30), (50, 10, 100, 30)]), N(cells=[(10, 30, 50, 50), None])])]

    def __init__(self, n):
        self.pages = [self.Page(k == 1) for k in range(n)]


def test_pages_and_regions_of_the_optional_library(monkeypatch):
    import sys
    from types import SimpleNamespace as N

    monkeypatch.setitem(sys.modules, "pdfplumber", N(open=lambda f: FakePdf(len(f.read()))))
    count, read = adapters.pdf_reader()(b"12")
    one, two = read(1), read(2)
    assert count == 2 and one["words"][0]["color"] == [0.0] and one["words"][-1]["color"] == [0.0, 0.0, 0.0]
    assert [(b["row_no"], b["col_no"], b["x0"]) for b in one["boxes"]] == [(1, 1, 10.0), (1, 2, 50.0), (2, 1, 10.0), (2, 2, None)]
    assert one["boxes"][0]["table_bottom"] == 50.0 and two["boxes"] == [] and two["structure_error"] == "no lines" and len(two["words"]) == len(one["words"])


def test_command_line_resolves_names_and_writes_a_file_each(spark, tmp_path, capsys):
    import cli

    rows = page("b", 1, ["این متن بدنه کتاب است و باید کافی باشد"]) + page("x", 1, ["متن"])
    spark.createDataFrame(rows, WORDS).write.parquet(f"file://{tmp_path}/words")
    spark.createDataFrame([], CELLS).write.parquet(f"file://{tmp_path}/cells")
    asked = [("b", "in/b.pdf", "", None, None), ("c", "c.txt", None, None, None), ("d", "d.pdf", "a ?? b", None, None)]
    spark.createDataFrame(asked, "book string, filename string, title string, course string, grade string").write.parquet(f"file://{tmp_path}/asked")
    (tmp_path / "side").mkdir()
    (tmp_path / "side" / "b.meta.json").write_text('{"book_title": "", "course": "علوم"}', encoding="utf-8")
    u = f"file://{tmp_path}"
    assert cli.main([f"{u}/asked", f"{u}/out", "--words", f"{u}/words", "--cells", f"{u}/cells", "--sidecars", f"{u}/side"]) == 1
    doc = json.loads((tmp_path / "out" / "json" / "b.json").read_text(encoding="utf-8"))
    assert doc["metadata"]["title"] == "b" and doc["metadata"]["course"] == "علوم" and len(doc["pages"]) == 1
    assert (tmp_path / "out" / "markdown" / "b.md").exists()
    said = capsys.readouterr().out
    assert "'total': 3, 'ok': 1, 'failed': 2" in said and "عنوان: b" in said
    with pytest.raises(SystemExit):
        cli.main([f"{u}/asked", f"{u}/out"])

"""The command line with staged runs, the page source and an extractor: stop, go on, ask once."""

import json
import os

from tests.test_engine import page


def answer():
    """An extractor that writes down that it is asked, in the file that its model is named after."""

    def send(request):
        with open(json.loads(request)["model"], "a") as f:
            f.write("asked\n")
        return {"content": [{"type": "tool_use", "name": "record_lesson_concepts", "input": {"concepts": [{"id": "a", "title": "کنش"}, {"id": "b", "title": "ما"}], "relationships": [{"source_concept_id": "a", "target_concept_id": "b", "relation_type": "related"}]}}]}

    return send


def lines(book):
    rows = page(book, 1, [("فهرست", 30.0), "فصل اول: جامعه .... 1", "درس اول: کنش ..... 2", "درس دوم : ما ...... 3"])
    rows += page(book, 2, [("فصل اول جامعه", 30.0), "این متن بدنه کتاب است و باید کافی باشد"])
    rows += page(book, 3, [("درس اول کنش", 30.0), "متن درس اول که به اندازه کافی بلند است"])
    rows += page(book, 4, [("درس دوم ما", 30.0), "متن درس دوم که به اندازه کافی بلند است"])
    names = ("word_no", "text", "x0", "x1", "top", "bottom", "size", "fontname", "color")
    out = []
    for n in range(1, 5):
        words = [dict(zip(names, r[2:], strict=True)) for r in rows if r[1] == n]
        out.append(json.dumps({"page": n, "page_w": 600.0, "page_h": 800.0, "words": words, "boxes": []}, ensure_ascii=False))
    return "\n".join(out) + "\n"


def test_a_run_is_stopped_goes_on_and_asks_once(spark, tmp_path, capsys):
    import cli

    asked = str(tmp_path / "asked.txt")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ب.jsonl").write_text(lines("ب"), encoding="utf-8")
    (tmp_path / "in" / "other.jsonl").write_text("not asked for, so not opened")
    u = f"file://{tmp_path}"
    spark.createDataFrame([("ب", "ب.pdf", "کتاب", None, "11")], "book string, filename string, title string, course string, grade string").write.parquet(f"{u}/asked")
    args = [f"{u}/asked", f"{u}/out", "--pdf", f"{u}/in", "--opener", "lines", "--work", f"{u}/work", "--extractor", "tests.test_cli_runs:answer", "--model", asked, "--log", f"{u}/log"]
    (tmp_path / "work").mkdir()
    (tmp_path / "work" / "_cancel").write_text("")
    assert cli.main(args) == 2 and "cancelled by user" in capsys.readouterr().out and not (tmp_path / "out").exists()
    (tmp_path / "work" / "_cancel").unlink()
    assert cli.main(args) == 0
    said = capsys.readouterr().out
    assert "stage extract_pages" in said and "stage export_knowledge_graph" in said and "'ok': 1, 'failed': 0" in said
    with open(asked) as f:
        assert len(f.readlines()) == 2  # a lesson each
    graph = json.loads((tmp_path / "out" / "graph" / "ب.graph.json").read_text(encoding="utf-8"))
    assert len(graph["concepts"]) == 4 and len(graph["relationships"]) == 2
    doc = json.loads((tmp_path / "out" / "json" / "ب.json").read_text(encoding="utf-8"))
    assert len(doc["pages"]) == 4 and doc["metadata"]["title"] == "کتاب" and (tmp_path / "out" / "seed" / "ب.seed.json").exists()
    before = os.stat(tmp_path / "work" / "00-extract_pages" / "_DONE").st_mtime_ns
    assert cli.main(args) == 0 and "stage" not in capsys.readouterr().out
    assert os.stat(tmp_path / "work" / "00-extract_pages" / "_DONE").st_mtime_ns == before
    with open(asked) as f:
        assert len(f.readlines()) == 2

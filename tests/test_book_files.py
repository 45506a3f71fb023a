"""Files of books: replaced together, old ones whole after a failed or killed write, committed writes ended later."""

import json
import os

import pytest
from pyspark.sql import functions as F

from varaq.sources import book_files
from varaq.sources.book_files import DRAFTS, MARK, write_books


def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "book string, doc string").repartition(3)


def files(path):
    return {f.name: f.read_text(encoding="utf-8") for f in path.iterdir() if f.is_file()}


def test_files_are_written_and_replaced(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    assert write_books(docs(spark, {"a": "یک\nدو", "b": "", "c": None}), at, "doc", ".md") == 3
    assert files(tmp_path / "out") == {"a.md": "یک\nدو", "b.md": "", "c.md": ""}
    assert write_books(docs(spark, {"a": "new", "d": "x" * 5_000_000}), at, "doc", ".md") == 2
    got = files(tmp_path / "out")
    assert got["a.md"] == "new" and got["b.md"] == "" and len(got["d.md"]) == 5_000_000
    assert not list((tmp_path / "out" / DRAFTS).iterdir())
    assert write_books(docs(spark, {"a": "x"}).limit(0), at, "doc", ".md") == 0 and files(tmp_path / "out")["a.md"] == "new"


def test_a_failing_task_leaves_the_old_files(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    write_books(docs(spark, {f"b{k}": "old" for k in range(20)}), at, "doc", ".md")
    new = docs(spark, {f"b{k}": "new" for k in range(20)}).withColumn("doc", F.when(F.col("book") == "b13", F.raise_error(F.lit("no text"))).otherwise(F.col("doc")))
    with pytest.raises(Exception, match="no text"):
        write_books(new, at, "doc", ".md")
    assert set(files(tmp_path / "out").values()) == {"old"} and len(files(tmp_path / "out")) == 20
    assert not list((tmp_path / "out" / DRAFTS).iterdir())  # aborted


@pytest.mark.parametrize("name", ["../x", "a/b", "", None, "..", "_drafts"])
def test_names_that_would_leave_the_folder(spark, tmp_path, name):
    with pytest.raises(Exception, match="not a name"):
        write_books(spark.createDataFrame([(name, "x")], "book string, doc string"), f"file://{tmp_path}/out", "doc", "")
    assert not (tmp_path / "x").exists()


def test_two_documents_of_one_book(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    write_books(docs(spark, {"a": "old"}), at, "doc", ".md")
    both = docs(spark, {"a": "1"}).union(docs(spark, {"a": "2"}))
    with pytest.raises(ValueError, match=r"a\.md"):
        write_books(both, at, "doc", ".md")
    assert files(tmp_path / "out") == {"a.md": "old"}


def test_a_killed_driver(spark, tmp_path, monkeypatch):
    """Killed before the commit: nothing happens. Killed while files are moved: the next write moves the rest first."""
    at = f"file://{tmp_path}/out"
    write_books(docs(spark, {f"b{k}": "old" for k in range(6)}), at, "doc", ".md")
    monkeypatch.setattr(book_files, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        write_books(docs(spark, {f"b{k}": "new" for k in range(6)}), at, "doc", ".md")
    monkeypatch.undo()
    assert set(files(tmp_path / "out").values()) == {"old"}
    left = next((tmp_path / "out" / DRAFTS).iterdir())
    manifest = json.loads((left / MARK).read_text())["manifests"][0]
    first = json.loads((left / manifest).read_text().split("\n")[0])
    os.replace(left / first["draft"], tmp_path / "out" / first["target"])  # one was moved before
    half = tmp_path / "out" / DRAFTS / "half"
    half.mkdir()
    (half / "x.draft").write_text("never committed")
    assert write_books(docs(spark, {"b0": "newest"}), at, "doc", ".md") == 1
    assert files(tmp_path / "out") == {"b0.md": "newest", **{f"b{k}.md": "new" for k in range(1, 6)}}
    assert not list((tmp_path / "out" / DRAFTS).iterdir())
    assert book_files.recover(spark, at) == 0

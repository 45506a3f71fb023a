"""Staged runs: stopped while a job works, taken up again, done anew where the input or an earlier stage is new."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tests.test_engine import CELLS, OCR, WORDS, page
from varaq.plans import engine, staged
from varaq.sources import files


@pytest.fixture
def lib(spark):
    rows = page("b", 1, [("فصل اول جامعه", 30.0), "این متن بدنه کتاب است و باید کافی باشد", "ادامه همان بند"]) + page("b", 2, ["کوتاه"])
    asked = spark.createDataFrame([("b", "b.pdf", "کتاب", None, "11")], "book string, filename string, title string, course string, grade string")
    return engine.Library(asked, spark.createDataFrame(rows, WORDS), spark.createDataFrame([], CELLS), spark.createDataFrame([("b", 2, "متن بازیابی شده از تصویر صفحه پنجم کتاب", 90.0, None)], OCR))


def slow(lib):
    """Some 25 minutes of sleeping tasks."""
    nap = F.udf(lambda k: time.sleep(1) or k, "bigint")("id")
    return {"slow": lib.requests.sparkSession.range(0, 6000, 1, 4).select(nap.alias("k"))}


def quick(name):
    return name, lambda lib: {name: lib.requests.select("book", F.lit(name).alias("stage"), F.lit(None).alias("nothing"))}


def test_staged_relations_equal_the_lazy_ones(spark, lib, tmp_path):
    seen = []
    out = staged.run(lib, f"file://{tmp_path}/w", "1", progress=seen.append)
    assert seen == [n for n, _ in engine.STAGES] and not out["lines"].is_cached
    got = {k: sorted(map(str, out[k].collect())) for k in ("pages", "blocks", "counts", "json", "markdown", "seed")}
    lazy = engine.run(engine.Library(lib.requests, lib.words, lib.cells, lib.ocr))
    assert got == {k: sorted(map(str, lazy[k].select(out[k].columns).collect())) for k in got}
    lazy.release()


def test_a_stop_ends_the_running_job_and_a_second_run_skips_what_is_done(spark, lib, tmp_path):
    begun, told, flag = [], [], threading.Event()
    stages = (quick("one"), ("slow", slow), quick("three"))
    watch = lambda p: (told.append(p), flag.set() if p.stage == "slow" and p.tasks else None)
    began = time.monotonic()
    with pytest.raises(staged.Stopped) as e:
        staged.run(lib, f"file://{tmp_path}/w", "1", stages, begun.append, flag.is_set, every=0.1, watching=watch)
    assert (e.value.stage, e.value.reason) == ("slow", staged.CANCELLED) and begun == ["one", "slow"]
    assert time.monotonic() - began < 60 and told[-1].stage == "slow" and told[-1].tasks >= 4
    tracker, until = spark.sparkContext.statusTracker(), time.monotonic() + 20
    while tracker.getActiveJobsIds() and time.monotonic() < until:
        time.sleep(0.1)
    assert not tracker.getActiveJobsIds()
    assert not (tmp_path / "w" / "01-slow" / "_DONE").exists() and not (tmp_path / "w" / "02-three").exists()
    begun.clear()
    out = staged.run(lib, f"file://{tmp_path}/w", "1", (stages[0], ("slow", lambda lib: {"slow": spark.range(3)}), stages[2]), begun.append)
    assert begun == ["slow", "three"] and out["slow"].count() == 3 and out["three"].first().stage == "three"
    assert spark.range(5).count() == 5  # later jobs carry no tag and are not cancelled
    assert len(spark.sparkContext.getJobTags()) == 0


def test_the_time_limit_holds_inside_a_stage(spark, lib, tmp_path):
    with pytest.raises(staged.Stopped) as e:
        staged.run(lib, f"file://{tmp_path}/w", "1", (("slow", slow),), timeout_seconds=2, every=0.1)
    assert e.value.reason == staged.TIMED_OUT
    with pytest.raises(staged.Stopped):
        staged.run(lib, f"file://{tmp_path}/w", "1", (quick("one"),), timeout_seconds=0)
    assert not (tmp_path / "w" / "00-one").exists()


def test_new_input_and_new_predecessors_are_done_anew(spark, lib, tmp_path):
    begun, stages, at = [], (quick("one"), quick("two")), f"file://{tmp_path}/w"
    staged.run(lib, at, "1", stages, begun.append)
    staged.run(lib, at, "1", stages, begun.append)
    assert begun == ["one", "two"]
    staged.run(lib, at, "2", stages, begun.append)
    assert begun == ["one", "two"] * 2
    files.write_text(spark, f"{at}/00-one/_DONE", "{")  # a marker that cannot be read
    staged.run(lib, at, "2", stages, begun.append)
    assert begun == ["one", "two"] * 3
    assert json.loads((tmp_path / "w" / "01-two" / "_DONE").read_text())["key"] == "2"


def test_errors_of_stages_and_of_the_question_are_told(spark, lib, tmp_path):
    def bad(lib):
        raise ValueError("no such page")

    with pytest.raises(ValueError, match="no such page"):
        staged.run(lib, f"file://{tmp_path}/w", "1", (("bad", bad),))
    asked = iter([False])  # then StopIteration, raised in the watching thread
    with pytest.raises(StopIteration):
        staged.run(lib, f"file://{tmp_path}/w", "1", (("slow", slow),), cancelled=lambda: next(asked), every=0.1)


def test_fingerprint_tells_changed_files(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    one = files.fingerprint(spark, f"file://{tmp_path}")
    assert one == files.fingerprint(spark, f"file://{tmp_path}")
    (tmp_path / "b").write_text("y")
    assert one != files.fingerprint(spark, f"file://{tmp_path}")
    files.write_text(spark, f"file://{tmp_path}/t", "متن")
    files.write_text(spark, f"file://{tmp_path}/t", "متن ۲")
    assert files.read_text(spark, f"file://{tmp_path}/t") == "متن ۲" and files.read_text(spark, f"file://{tmp_path}/u") is None

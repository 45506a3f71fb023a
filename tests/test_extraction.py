"""Asking an extractor: what is sent, what is not asked twice, failures, retries, and an extractor that is not configured."""

import json
import os
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from varaq.operators import extraction
from varaq.operators.extraction import NotConfigured, answers, ask, outcomes, read_log, requests, warnings

ANSWER = {"concepts": [{"id": "social-action", "title": "کنش اجتماعی", "confidence_score": 0.9}], "relationships": []}


def prompts(spark, texts):
    return spark.createDataFrame([("b", k, f"درس {k}", t) for k, t in texts.items()], "book string, lesson_order int, title string, prompt string")


def note(log, line):
    with open(log, "a") as f:
        f.write(line + "\n")


def client_of(log):
    """Answers by what the lesson says; writes down each request."""
    note(log, "client")

    def send(request):
        text = json.loads(request)["messages"][0]["content"]
        note(log, f"ask {text}")
        if "slow" in text:
            time.sleep(0.3)
        if "fails" in text and not os.path.exists(log + ".mended"):
            raise RuntimeError("overloaded")
        if "silent" in text:
            return {"content": [{"type": "text", "text": "no tool"}]}
        return {"content": [{"type": "text", "text": "x"}, {"type": "tool_use", "name": extraction.TOOL, "input": ANSWER}]}

    return send


def no_key_of(log):
    note(log, "client")
    raise NotConfigured("no key")


@pytest.fixture
def place(tmp_path):
    (tmp_path / "asked").write_text("")
    return tmp_path


@pytest.fixture
def client(place):
    return partial(client_of, str(place / "asked"))


@pytest.fixture
def no_key(place):
    return partial(no_key_of, str(place / "asked"))


def asked(place):
    return sorted(x for x in (place / "asked").read_text().split("\n") if x.startswith("ask"))


def test_the_request(spark):
    r = requests(prompts(spark, {1: 'متن "یک"\n\n---'}), "some-model").first()
    sent = json.loads(r.request)
    assert set(sent) == {"model", "max_tokens", "system", "messages", "tools", "tool_choice"}
    assert sent["model"] == "some-model" and sent["max_tokens"] == 4096 and sent["messages"] == [{"role": "user", "content": 'متن "یک"\n\n---'}]
    assert sent["tool_choice"] == {"type": "tool", "name": "record_lesson_concepts"} and [t["name"] for t in sent["tools"]] == ["record_lesson_concepts"]
    shape = sent["tools"][0]["input_schema"]
    assert shape["required"] == ["concepts", "relationships"]
    concept, edge = (shape["properties"][k]["items"] for k in ("concepts", "relationships"))
    assert list(concept["properties"]) == ["id", "title", "definition", "explanation", "examples", "common_misconceptions", "confidence_score"] and concept["required"] == ["id", "title"]
    assert edge["required"] == ["source_concept_id", "target_concept_id", "relation_type"] and "frequently_confused" in edge["properties"]["relation_type"]["enum"]
    same, other = (requests(prompts(spark, {1: 'متن "یک"\n\n---'}), m).first().digest for m in ("some-model", "other-model"))
    assert same == r.digest != other


def test_a_second_run_asks_nothing_and_failures_are_asked_again(spark, place, client):
    log = f"file://{place}/log"
    wanted = requests(prompts(spark, {1: "one", 2: "it fails", 3: "silent", 4: "one"}), "m")
    assert ask(wanted, log, client, pause=0.01, rounds=2) is None
    assert asked(place) == ["ask it fails"] * 3 + ["ask one", "ask silent"]  # three tries; equal requests once
    got = {r.lesson_order: r for r in outcomes(wanted, read_log(spark, log)).collect()}
    assert json.loads(got[1].response) == ANSWER == json.loads(got[4].response)
    assert json.loads(got[3].response) == {"concepts": [], "relationships": []}
    assert got[2].response is None and got[2].error == "overloaded"
    lessons, books = wanted.select("book"), spark.createDataFrame([("b",), ("c",), ("d",)], "book string")
    outline = spark.createDataFrame([("b",), ("d",)], "book string")
    said = sorted(map(tuple, warnings(books, outline, lessons, outcomes(wanted, read_log(spark, log)), None).collect()))
    assert said == [
        ("b", "Concept extraction failed for lesson 2 (درس 2): overloaded"),
        ("c", "Concept extraction skipped: no table-of-contents outline was found, so lesson boundaries couldn't be resolved."),
        ("d", "Concept extraction skipped: could not resolve lesson page ranges from the outline."),
    ]
    (place / "asked").write_text("")
    (place / "asked.mended").write_text("")
    more = requests(prompts(spark, {1: "one", 2: "it fails", 3: "silent", 4: "one", 5: "new"}), "m")
    assert ask(more, log, client, pause=0.01, rounds=2) is None
    assert asked(place) == ["ask it fails", "ask new"]
    assert outcomes(more, read_log(spark, log)).where("response is null or error is not null").count() == 0
    (place / "asked").write_text("")
    assert ask(more, log, client, rounds=2) is None and (place / "asked").read_text() == ""


def test_not_configured_asks_nothing_and_is_one_warning(spark, place, client, no_key):
    log = f"file://{place}/log"
    wanted = requests(prompts(spark, {k: f"lesson {k}" for k in range(20)}), "m")
    assert ask(wanted, log, no_key, tasks=2) == "no key"
    assert asked(place) == [] and (place / "asked").read_text().count("client") <= 2  # the first round's tasks only
    found = outcomes(wanted, read_log(spark, log))
    assert found.where("response is not null or error is not null").count() == 0
    one = spark.createDataFrame([("b",)], "book string")
    assert [tuple(r) for r in warnings(one, one, one, found, "no key").collect()] == [("b", "Concept extraction skipped: no key")]
    assert ask(wanted, log, client) is None and len(asked(place)) == 20


def test_requests_on_their_way_are_bounded(spark, place, client):
    wanted = requests(prompts(spark, {k: f"slow {k}" for k in range(8)}), "m")
    began = time.monotonic()
    ask(wanted, f"file://{place}/log", client, tasks=1, at_once=8, rounds=1)
    assert len(asked(place)) == 8 and time.monotonic() - began < 30
    run = extraction._sender(client, 2, 1, 0)
    import pandas as pd

    pulled = []

    def batches():
        for k in range(6):
            pulled.append(k)
            yield pd.DataFrame({"digest": [str(k)], "request": [json.dumps({"messages": [{"content": "x"}]})]})

    out = run(batches())
    next(out)
    assert len(pulled) <= 4  # two on their way, and those that came after the ones that ended
    assert len(list(out)) == 5 and pulled == list(range(6))


def test_the_last_answer_counts_and_errors_only_without_one(spark):
    t = "2026-01-01 00:00:0"
    rows = [("a", "1", None, 1, t + "1"), ("a", None, "e", 1, t + "2"), ("a", "2", None, 1, t + "3"), ("b", None, "e1", 3, t + "1"), ("b", None, "e2", 3, t + "2"), (None, None, "not configured: x", 0, t + "1")]
    log = spark.createDataFrame(rows, "digest string, response string, error string, tries int, at string").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted(map(tuple, answers(log).collect())) == [("a", "2", None), ("b", None, "e2")]


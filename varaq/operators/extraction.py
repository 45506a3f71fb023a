"""Asking an extractor about lessons: requests, a log of answers by content, and what became of each lesson.

A request is told by the digest of all that is sent (model, limits, instructions, tool and lesson). Answers are appended to a
log, a Parquet folder, under their digest; only digests without an answer are asked, equal ones once. So a second run
over the same lessons asks nothing, a lesson whose text or book data has changed is asked anew, and so is one that failed.
The lessons are asked in rounds, each appended when it ends, so that a run that is killed has lost one round at most.

Clients are made once a task by a factory. A factory that raises NotConfigured (no key, say) ends the asking: nothing is
sent, and there is one warning for a book, not one for each of its lessons.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import UTC, datetime
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varaq.functions.rules import RELATION_TYPES

#: The tool's name, its fields and what is required of them, and the limit of an answer.
TOOL = "record_lesson_concepts"
MAX_TOKENS = 4096
_TEXT, _TEXTS = {"type": "string"}, {"type": "array", "items": {"type": "string"}}
TOOL_INPUT = {
    "type": "object",
    "properties": {
        "concepts": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {
                    "id": _TEXT | {"description": "English slug, unique in this answer; relationships name it."},
                    "title": _TEXT | {"description": "The concept's name in the language of the lesson."},
                    "definition": _TEXT,
                    "explanation": _TEXT,
                    "examples": _TEXTS,
                    "common_misconceptions": _TEXTS,
                    "confidence_score": {"type": "number", "description": "From 0 (loosely implied) to 1 (plainly taught)."},
                },
                "required": ["id", "title"],
            },
        },
        "relationships": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {"source_concept_id": _TEXT, "target_concept_id": _TEXT, "relation_type": {"type": "string", "enum": list(RELATION_TYPES)}, "notes": _TEXT},
                "required": ["source_concept_id", "target_concept_id", "relation_type"],
            },
        },
    },
    "required": ["concepts", "relationships"],
}
INSTRUCTIONS = (
    "You read one lesson of a Persian school textbook and record what it teaches as concepts and as relationships between them. "
    "Use the language of the lesson. Record only what the text itself teaches, and only relationships whose two ends are "
    "both among your concepts; where you are in doubt, leave it out."
)

LOG = "digest string, response string, error string, tries int, at timestamp, run string"
_SENT = "digest string, response string, error string, tries int, at timestamp"
_ANSWER = "content array<struct<type: string, input: string>>"
_EMPTY = '{"concepts":[],"relationships":[]}'
NOT_CONFIGURED = "not configured"


class NotConfigured(RuntimeError):
    """The extractor cannot be asked at all."""


#: Sends a request (JSON) and gives the answer (JSON, or what json.dumps takes).
Client = Callable[[str], object]


def requests(prompts: DataFrame, model: str, max_tokens: int = MAX_TOKENS, instructions: str = INSTRUCTIONS) -> DataFrame:
    """book, lesson_order, title, request, digest. prompts: book, lesson_order, title, prompt."""
    head = json.dumps({"model": model, "max_tokens": max_tokens, "system": instructions}, ensure_ascii=False)[:-1]
    tool = {"name": TOOL, "description": "Record the concepts that this lesson teaches and how they are related.", "input_schema": TOOL_INPUT}
    tail = json.dumps({"tools": [tool], "tool_choice": {"type": "tool", "name": TOOL}}, ensure_ascii=False)[1:]
    message = F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.coalesce("prompt", F.lit("")).alias("content"))))
    request = F.concat(F.lit(head + ', "messages": '), message, F.lit(", " + tail))
    return prompts.select("book", "lesson_order", "title", request.alias("request")).withColumn("digest", F.sha2("request", 256))


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All that was written down; an empty relation if there is no log yet."""
    from varaq.sources.files import exists

    return spark.read.schema(LOG).parquet(log) if exists(spark, log) else spark.createDataFrame([], LOG)


def answers(log: DataFrame) -> DataFrame:
    """digest, response, error: the last answer of each request, or its last error if it was never answered."""
    good = F.col("response").isNotNull()
    return log.where("digest is not null").groupBy("digest").agg(
        F.max_by(F.when(good, F.col("response")), F.when(good, F.col("at"))).alias("response"), F.when(~F.bool_or(good), F.max_by("error", "at")).alias("error")
    )


def _sender(client: Callable[[], Client], at_once: int, tries: int, pause: float):
    def send(ask: Client, digest: str, request: str) -> tuple:
        for k in range(1, tries + 1):
            try:
                got = ask(request)
                text = got if isinstance(got, str) else json.dumps(got, ensure_ascii=False)
                return digest, text, None, k, datetime.now(UTC).replace(tzinfo=None)
            except Exception as e:
                error = str(e) or type(e).__name__
                if isinstance(e, NotConfigured) or k == tries:
                    break
                time.sleep(pause * 2 ** (k - 1))
        return digest, None, error, k, datetime.now(UTC).replace(tzinfo=None)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Answers as they come; at most `at_once` requests are on their way."""
        asked = ((r.digest, r.request) for pdf in batches for r in pdf.itertuples(index=False))
        first = next(asked, None)
        if first is None:
            return
        try:
            ask = client()
        except NotConfigured as e:
            yield None, None, f"{NOT_CONFIGURED}: {e}", 0, datetime.now(UTC).replace(tzinfo=None)
            return
        with ThreadPoolExecutor(at_once) as pool:
            running: set[Future] = {pool.submit(send, ask, *first)}
            running |= {pool.submit(send, ask, *x) for x in islice(asked, at_once - 1)}
            while running:
                done, running = wait(running, return_when=FIRST_COMPLETED)
                running |= {pool.submit(send, ask, *x) for x in islice(asked, len(done))}
                yield from (f.result() for f in done)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in rows(batches):
            yield pd.DataFrame([row], columns=["digest", "response", "error", "tries", "at"])

    return run


def ask(wanted: DataFrame, log: str, client: Callable[[], Client], tasks: int = 4, at_once: int = 4, tries: int = 3, pause: float = 1.0, rounds: int = 8) -> str | None:
    """Ask what the log has no answer to and append the answers; why asking ended early, if it did.

    wanted: as of requests(). At most tasks x at_once requests are on their way; each is tried `tries` times, with
    pauses that double.
    """
    spark, run = wanted.sparkSession, uuid.uuid4().hex
    once = wanted.select("digest", "request").dropDuplicates(["digest"])
    part = F.pmod(F.xxhash64("digest"), F.lit(rounds))
    for k in range(rounds):
        known = answers(read_log(spark, log)).where("response is not null").select("digest")
        open_ = once.where(part == k).join(known, "digest", "left_anti").repartition(tasks)
        if open_.limit(1).count():
            # not persisted: what reads the log is computed again when the log is appended to, and would ask again
            got = open_.mapInPandas(_sender(client, at_once, tries, pause), _SENT).withColumn("run", F.lit(f"{run}-{k}"))
            got.write.mode("append").parquet(log)
            stop = read_log(spark, log).where((F.col("run") == f"{run}-{k}") & F.col("digest").isNull()).select("error").first()
            if stop:
                return stop.error.removeprefix(f"{NOT_CONFIGURED}: ")
    return None


def outcomes(wanted: DataFrame, log: DataFrame) -> DataFrame:
    """book, lesson_order, title, response (what the tool was called with), error, for each lesson that was asked.

    An answer without a call of the tool has no concepts. A lesson that nobody has asked has neither response nor error.
    """
    got = wanted.select("book", "lesson_order", "title", "digest").join(answers(log), "digest", "left")
    called = F.get(F.filter(F.from_json("response", _ANSWER)["content"], lambda b: b["type"] == "tool_use"), F.lit(0))["input"]
    return got.select("book", "lesson_order", "title", F.when(F.col("response").isNotNull(), F.coalesce(called, F.lit(_EMPTY))).alias("response"), "error")


def warnings(books: DataFrame, outline: DataFrame, lessons: DataFrame, found: DataFrame, stopped: str | None) -> DataFrame:
    """book, warning: why a book has no concepts, or which of its lessons failed.

    books: book; outline: as of operators.outline; lessons: those with pages; found: as of outcomes().
    """
    no_outline = books.join(outline.select("book").distinct(), "book", "left_anti").select("book", F.lit("Concept extraction skipped: no table-of-contents outline was found, so lesson boundaries couldn't be resolved.").alias("warning"))
    no_lessons = books.join(outline.select("book").distinct(), "book").join(lessons.select("book").distinct(), "book", "left_anti").select("book", F.lit("Concept extraction skipped: could not resolve lesson page ranges from the outline.").alias("warning"))
    if stopped is not None:
        unasked = found.where("response is null and error is null").select("book").distinct()
        why = unasked.select("book", F.lit(f"Concept extraction skipped: {stopped}").alias("warning"))
    else:
        why = found.limit(0).select("book", F.lit("").alias("warning"))
    failed = found.where("error is not null")
    text = F.concat(F.lit("Concept extraction failed for lesson "), F.col("lesson_order").cast("string"), F.lit(" ("), F.coalesce("title", F.lit("")), F.lit("): "), F.col("error"))
    return no_outline.unionByName(no_lessons).unionByName(why).unionByName(failed.select("book", text.alias("warning")))

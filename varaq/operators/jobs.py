"""The job table: events, current state, transitions, queries.

events: id, seq and the job columns that changed (null: unchanged). jobs: one row an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.config import SETTINGS
from varaq.functions.rules import RUNNING, TERMINAL, elapsed_seconds

#: Columns that an update may change.
MUTABLE = ("state", "started_at", "completed_at", "error_summary", "local_input_path", "output_paths", "total_pages", "processed_pages", "ocr_page_count", "warnings", "cancellation_requested", "status_message_id", "file_sha256")
# What a state is called.
LABELS = {
    "received": "✅ فایل دریافت شد",
    "validating": "🔎 در حال اعتبارسنجی فایل",
    "queued": "⏳ در صف پردازش",
    "downloading": "📥 در حال آماده‌سازی فایل",
    "ready": "✅ فایل آماده پردازش است",
    "processing": "⚙️ در حال پردازش",
    "extracting": "📖 در حال استخراج متن",
    "ocr": "🔎 در حال اجرای OCR",
    "exporting": "📦 در حال ساخت خروجی‌ها",
    "completed": "✅ پردازش کامل شد",
    "failed": "❌ پردازش ناموفق بود",
    "cancel_requested": "🛑 درخواست لغو ثبت شد",
    "cancelled": "🛑 پردازش لغو شد",
}


def check_update(columns: list[str]) -> None:
    unknown = sorted({*columns} - {*MUTABLE})
    if unknown:
        raise ValueError(f"columns that an update may not change: {', '.join(unknown)}")


def current(events: DataFrame) -> DataFrame:
    """The latest value of each column for each id: a partial aggregation, so a busy job is no hot task."""
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
    return events.groupBy("id").agg(*(latest(c) for c in events.columns if c not in ("id", "seq")))


def latest_jobs(jobs: DataFrame) -> DataFrame:
    """Each user's newest job."""
    newest = F.max_by(F.struct("id", "state", "created_at"), F.struct("created_at", "id"))
    return jobs.groupBy("user_id").agg(newest.alias("j")).select("user_id", "j.*")


def queue_positions(jobs: DataFrame) -> DataFrame:
    """id, position: queued jobs not newer than this one. Counted by time first, so ties share a number."""
    times = jobs.where("state = 'queued'").groupBy("created_at").agg(F.count("*").alias("n"))
    day = F.date_trunc("day", "created_at")
    days = times.groupBy(day.alias("day")).agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a day
    days = days.select("day", before.alias("before"))
    within = Window.partitionBy("day").orderBy("created_at").rowsBetween(Window.unboundedPreceding, 0)
    at = times.withColumn("day", day).join(days, "day").select("created_at", (F.col("before") + F.sum("n").over(within)).alias("position"))
    return jobs.where("state = 'queued'").join(at, "created_at").select("id", "position")


def active_duplicates(jobs: DataFrame) -> DataFrame:
    """unique_id, id: the newest job that is not finished, whoever sent it."""
    live = jobs.where(~F.col("state").isin(*TERMINAL))
    return live.groupBy("unique_id").agg(F.max_by("id", F.struct("created_at", "id")).alias("id"))


def cancel(jobs: DataFrame, user_id: Column, now: Column) -> DataFrame:
    """jobs after their owner's request to cancel, with changed: whether it had an effect."""
    may = (F.col("user_id") == user_id) & ~F.col("state").isin(*TERMINAL)
    waiting = F.col("state").isin("received", "validating", "queued")
    return jobs.withColumns(
        {
            "changed": may,
            "cancellation_requested": F.coalesce(F.col("cancellation_requested"), F.lit(False)) | may,
            "state": F.when(may & waiting, "cancelled").when(may, "cancel_requested").otherwise(F.col("state")),
            "completed_at": F.when(may & waiting, now).otherwise(F.col("completed_at")),
        }
    )


def recovered(jobs: DataFrame, now: Column) -> DataFrame:
    """jobs after a restart: running ones have failed; queued ones wait on."""
    lost = F.col("state").isin(*RUNNING)
    return jobs.withColumns(
        {
            "error_summary": F.when(lost, "interrupted by bot restart").otherwise(F.col("error_summary")),
            "completed_at": F.when(lost, now).otherwise(F.col("completed_at")),
            "state": F.when(lost, "failed").otherwise(F.col("state")),
        }
    )


def queued(jobs: DataFrame) -> DataFrame:
    return jobs.where("state = 'queued'").orderBy("created_at", "id")


def expired(jobs: DataFrame, cutoff: Column) -> DataFrame:
    """Finished jobs from before the cutoff; without a time of completion they stay."""
    return jobs.where(F.col("state").isin(*TERMINAL) & (F.col("completed_at") < cutoff))


def artifacts(jobs: DataFrame, roots: list[str]) -> DataFrame:
    """id, path of the files that go with a job: under an allowed root and named after the job."""
    from varaq.functions.rules import within_roots

    paths = F.array_compact(F.concat(F.array("local_input_path"), F.coalesce("output_paths", F.array().cast("array<string>"))))
    one = jobs.select("id", F.explode(F.array_distinct(paths)).alias("path"))
    return one.where(within_roots(F.col("path"), roots) & F.substring_index("path", "/", -1).startswith(F.concat(F.col("id"), F.lit("-"))))


def admitted(arrivals: DataFrame, capacity: int = SETTINGS.queue_capacity) -> DataFrame:
    """arrivals (id, created_at) with admitted: the first ones up to the capacity. The top rows alone are kept in
    order, so no task sorts all."""
    first = arrivals.orderBy("created_at", "id").limit(capacity).select("id", F.lit(True).alias("admitted"))
    return arrivals.join(F.broadcast(first), "id", "left").withColumn("admitted", F.coalesce("admitted", F.lit(False)))  # capacity rows


def status_edits(progress: DataFrame, seconds: int = SETTINGS.status_seconds) -> DataFrame:
    """id, at of the progress reports (id, at) that are shown: a job's first, then each that comes `seconds` or more after
    the last one shown. Reports pass in the order of time, and only the last one shown is remembered."""
    wait = pd.Timedelta(seconds=seconds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        job, last = None, None
        for pdf in batches:
            shown = []
            for i, at in zip(pdf["id"], pdf["at"], strict=True):
                show = last is None or i != job or at >= last + wait
                if show:
                    job, last = i, at
                shown.append(show)
            yield pdf[shown]

    rows = progress.where("id is not null and at is not null").select("id", F.col("at").cast("timestamp").alias("at"))
    return rows.repartition("id").sortWithinPartitions("id", "at").mapInPandas(run, rows.schema)


def timed_out(jobs: DataFrame, now: Column, limit: int = SETTINGS.timeout_seconds) -> DataFrame:
    return jobs.where(F.col("state").isin(*RUNNING) & (elapsed_seconds(F.col("created_at"), F.col("started_at"), now, now) > limit))


def status_text(position: Column, now: Column) -> Column:
    """The status message of a job row."""
    pairs = [x for k, v in LABELS.items() for x in (F.lit(k), F.lit(v))]
    say = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c.cast("string")))
    seconds = elapsed_seconds(F.col("created_at"), F.col("started_at"), F.col("completed_at"), now)
    return F.concat_ws(
        "\n",
        F.try_element_at(F.create_map(*pairs), F.col("state")),
        say("شناسه", F.col("id")),
        say("فایل", F.col("filename")),
        say("جایگاه صف", position),
        say("تعداد صفحات", F.col("total_pages")),
        say("صفحات پردازش‌شده", F.col("processed_pages")),
        say("صفحات OCR شده", F.col("ocr_page_count")),
        F.concat(F.lit("زمان سپری‌شده: "), seconds.cast("string"), F.lit(" ثانیه")),
        F.when(F.col("state") == "completed", say("تعداد خروجی‌ها", F.size("output_paths"))),
        F.when((F.col("state") == "failed") & (F.coalesce("error_summary", F.lit("")) != ""), say("علت", F.col("error_summary"))),
    )


def completion_text() -> Column:
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    warned = F.when(F.size("warnings") > 0, F.concat(F.lit("\nهشدارها: "), F.size("warnings").cast("string"))).otherwise("")
    return F.concat(F.lit("✅ پردازش با موفقیت تمام شد.\nفایل: "), "filename", F.lit("\nصفحات: "), n("total_pages"), F.lit("\nصفحات OCR شده: "), n("ocr_page_count"), F.lit("\nخروجی‌ها: "), F.size("output_paths").cast("string"), warned)

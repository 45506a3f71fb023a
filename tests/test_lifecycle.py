"""The lifecycle stream: random logs against a plain machine, in any batches and across a restart; timers; delivery."""

import random
from datetime import datetime, timedelta

import pytest

from varaq.functions.rules import STAGE_STATE
from varaq.streaming import lifecycle as L

DAY = datetime(2026, 1, 1)


def plain(events, timeout):
    """Each job's state, warnings and error, by the rules as a worker applies them, one `if` each."""
    jobs = {}
    for i, seq, event, stage, at, error in sorted(events, key=lambda e: (e[0], e[1])):
        j = jobs.setdefault(i, {"state": None, "seq": -1, "warnings": [], "error": None, "started": None})
        s = j["state"]
        if seq <= j["seq"]:
            continue
        new = None
        running = s in ("downloading", "ready", "processing", "extracting", "ocr", "exporting")
        if event == "received" and s is None:
            new = "received"
        elif event == "validating" and s == "received" or event == "queued" and s in ("received", "validating"):
            new = event
        elif event == "started" and s == "queued":
            new, j["started"] = "downloading", at
        elif event == "cancel" and s in ("received", "validating", "queued"):
            new, j["error"] = "cancelled", "cancelled by user"
        elif event == "cancel" and running:
            new = "cancel_requested"
        elif event in ("ready", "stage") and s == "cancel_requested":
            new, j["error"] = "cancelled", "cancelled by user"
        elif event == "ready" and s == "downloading" or event == "stage" and running and s != "downloading":
            if at - j["started"] >= timedelta(seconds=timeout):
                new, j["error"] = "failed", "processing timeout reached"
            else:
                new = "ready" if event == "ready" else STAGE_STATE.get(stage, "processing")
        elif event == "processing" and s == "ready":
            new = "processing"
        elif event == "finished" and (running and s not in ("downloading", "ready") or s == "cancel_requested"):
            new = "completed"
        elif event == "error" and (running or s in ("received", "validating", "queued", "cancel_requested")):
            new, j["error"] = "failed", error
        elif event == "delivery_failed" and s == "completed" and not j["warnings"]:
            new, j["warnings"] = "completed", ["TELEGRAM_DELIVERY_FAILED"]
        if new:
            j["state"], j["seq"] = new, seq
    return {i: (j["state"], j["seq"], j["error"], j["warnings"]) for i, j in jobs.items() if j["state"]}


def random_log(seed, n=120):
    rng = random.Random(seed)
    good = ["received", "validating", "queued", "started", "ready", "processing", "stage", "stage", "stage", "finished", "delivery_failed"]
    events = []
    for k in range(n):
        at, seq = DAY + timedelta(seconds=rng.randrange(3000)), 0
        for event in good:
            for e in [event] * rng.choice([1, 1, 1, 1, 0, 2]) + rng.choices(["cancel", "error", "stage", "queued", "what"], k=rng.choice([0, 0, 0, 0, 1])):
                at, seq = at + timedelta(seconds=rng.choice([1, 30, 400])), seq + rng.choice([1, 1, 2])
                events.append((f"j{k}", seq, e, rng.choice([*STAGE_STATE, "other", None]), at, "boom" if e == "error" else None))
    events += rng.choices(events, k=40)  # seen before
    return sorted(events, key=lambda e: e[4])


def latest(rows):
    out = {}
    for r in rows:
        if not r.expired and (r.id not in out or r.seq > out[r.id].seq):
            out[r.id] = r
    return {i: (r.state, r.seq, r.error_summary, r.warnings) for i, r in out.items()}


def write(spark, path, events, k):
    spark.createDataFrame(events, L.EVENTS).coalesce(1).write.mode("append").parquet(f"{path}/in/{k:03d}")


def run(spark, path, files):
    stream = spark.readStream.schema(L.EVENTS).option("maxFilesPerTrigger", files).parquet(f"{path}/in/*")
    q = L.lifecycle(stream, "10 seconds", timeout_seconds=1000, retention_hours=1).writeStream.outputMode("update").option("checkpointLocation", f"{path}/check")
    out = q.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out/{n}")).trigger(availableNow=True).start()
    out.awaitTermination(150)
    assert out.exception() is None


def test_a_random_log_across_a_restart(spark, tmp_path):
    path, events = f"file://{tmp_path}", random_log(1)
    cut = len(events) * 3 // 5
    for k, part in enumerate((events[: cut // 2], events[cut // 2 : cut])):
        write(spark, path, part, k)
    run(spark, path, 1)
    write(spark, path, events[cut:], 2)
    run(spark, path, 1)  # from the checkpoint
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/out").collect()
    want = plain(events, 1000)
    assert latest(rows) == want and {s for s, *_ in want.values()} >= {"completed", "failed", "cancelled"}
    seen = max(e[4] for e in events) - timedelta(seconds=10, hours=1)
    over = {i for i, j in L.replayed(events, 1000).items() if j.state in ("completed", "failed", "cancelled") and datetime(1970, 1, 1) + timedelta(microseconds=j.at) < seen}
    first = {r.id for r in rows if r.expired}
    assert over and first <= {i for i, (state, *_) in want.items() if state in ("completed", "failed", "cancelled")}
    assert len(first ^ over) <= len(over) // 5  # a delivery that failed later moves `at`, but not the timer


@pytest.mark.parametrize("seed", range(30))
def test_the_table_of_moves_is_the_plain_machine(seed):
    events = random_log(seed, 60)
    got = {i: (j.state, j.seq, j.error, list(j.warnings)) for i, j in L.replayed(events, 1000).items()}
    assert got == plain(events, 1000)


def test_delivery_deadline_and_cancellation():
    at = lambda s: DAY + timedelta(seconds=s)
    start = [("j", 1, "received", None, at(0), None), ("j", 2, "queued", None, at(1), None), ("j", 3, "started", None, at(2), None), ("j", 4, "ready", None, at(3), None)]
    one = lambda *more: L.replayed([*start, *more], 100)["j"]
    assert one(("j", 5, "stage", "extract_pages", at(101), None)).state == "extracting"
    late = one(("j", 5, "stage", "extract_pages", at(102), None), ("j", 6, "finished", None, at(103), None))
    assert (late.state, late.error) == ("failed", "processing timeout reached")
    beyond = one(("j", 5, "stage", "export", at(50), None), ("j", 6, "finished", None, at(500), None), ("j", 7, "delivery_failed", None, at(501), None), ("j", 8, "delivery_failed", None, at(502), None))
    assert (beyond.state, beyond.warnings, beyond.error) == ("completed", ("TELEGRAM_DELIVERY_FAILED",), None)  # no boundary after the last stage
    assert one(("j", 5, "cancel", None, at(5), None)).state == "cancel_requested"
    assert one(("j", 5, "cancel", None, at(5), None), ("j", 6, "stage", "export", at(6), None)).state == "cancelled"
    assert one(("j", 5, "cancel", None, at(5), None), ("j", 6, "finished", None, at(6), None)).state == "completed"

"""The bounded queue: a stream in any batches and across a restart against asyncio's own queue with workers."""

import asyncio
import random

import pytest

from varaq.streaming import queue as Q


def log(seed, n=160, names=("a",)):
    rng, out, submitted = random.Random(seed), [], {q: [] for q in names}
    for seq in range(n):
        q = rng.choice(names)
        event = rng.choice(["submit", "submit", "submit", "end", "end", "cancel"])
        if event == "submit":
            submitted[q].append(f"{q}{seq}")
            out.append((q, seq, event, f"{q}{seq}"))
        elif submitted[q]:
            out.append((q, seq, event, rng.choice(submitted[q][-8:])))
    return out


def with_asyncio(events, capacity, concurrency):
    """The same by asyncio.Queue and worker tasks, which start a job when they take it and go on when it is told to end."""

    async def run():
        waiting, out, over, cancelled, known = asyncio.Queue(maxsize=capacity), [], {}, set(), set()
        now = [0]

        async def worker():
            while True:
                job = await waiting.get()
                if job in cancelled:
                    out.append((now[0], job, "skipped"))
                    continue
                out.append((now[0], job, "started"))
                over[job] = asyncio.Event()
                await over[job].wait()
                del over[job]

        workers = [asyncio.create_task(worker()) for _ in range(concurrency)]

        async def settle():
            for _ in range(4 * (capacity + concurrency)):
                await asyncio.sleep(0)

        await settle()
        for _, seq, event, job in events:
            now[0] = seq
            if event == "submit" and job not in known:
                known.add(job)
                try:
                    waiting.put_nowait(job)
                    before = len(out)
                    await settle()
                    if len(out) == before:
                        out.append((seq, job, "queued"))
                except asyncio.QueueFull:
                    out.append((seq, job, "rejected"))
            elif event == "cancel" and job not in over:
                cancelled.add(job)
            elif event == "end" and job in over:
                over[job].set()
            await settle()
        for w in workers:
            w.cancel()
        return out

    return asyncio.run(run())


@pytest.mark.parametrize("seed, capacity, concurrency", [(1, 3, 1), (2, 10, 1), (3, 2, 3), (4, 1, 1), (5, 5, 2)])
def test_places_equal_a_queue_with_workers(seed, capacity, concurrency):
    events, places, got = log(seed), Q.Places(), []
    for _, seq, event, job in events:
        got += [(seq, i, what) for i, what, _ in places.take(seq, event, job, capacity, concurrency)]
        assert len(places.waiting) <= capacity and len(places.running) <= concurrency
        assert places.take(seq, event, job, capacity, concurrency) == []  # seen before
    want = with_asyncio(events, capacity, concurrency)
    assert sorted(got) == sorted(want) and {w for *_, w in want} >= {"started", "queued", "rejected"}


def test_the_stream_across_a_restart(spark, tmp_path):
    events, at = log(7, 240, ("a", "b", "c")), f"file://{tmp_path}"
    for k in range(4):
        part = events[k * 60 : k * 60 + 60]
        spark.createDataFrame(part + part[:3], Q.EVENTS).coalesce(1).write.parquet(f"{at}/in/{k}")
        if k % 2:
            stream = spark.readStream.schema(Q.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{at}/in/*")
            q = Q.decisions(stream, 2, 1).writeStream.option("checkpointLocation", f"{at}/check").trigger(availableNow=True)
            q = q.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{at}/out/{n}")).start()
            q.awaitTermination(100)
            assert q.exception() is None
    got = spark.read.option("recursiveFileLookup", True).parquet(f"{at}/out").collect()
    want = []
    for name in "abc":
        places = Q.Places()
        want += [(name, s, i, w, p) for q, s, e, j in events if q == name for i, w, p in places.take(s, e, j, 2, 1)]
    assert sorted((r.queue, r.seq, r.id, r.what, r.position or 0) for r in got) == sorted((*x[:4], x[4] or 0) for x in want)

"""The kept job table and throttled status edits: any cut into batches gives what the whole history gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from varaq.operators import jobs
from varaq.sources import files
from varaq.streaming import job_table, throttle

EVENTS = "id string, seq bigint, state string, total_pages int, warnings array<string>"


def events(seed, n=300):
    rng = random.Random(seed)
    maybe = lambda x: rng.choice([None, x, x])
    return [(f"j{rng.choice([0, 0, 0, *range(40)])}", k, maybe(rng.choice(["queued", "ready", "failed"])), maybe(k), maybe([f"w{k}"])) for k in range(n)]


def rows(df):
    return sorted(map(str, df.select("id", "state", "total_pages", "warnings").collect()))


@pytest.mark.parametrize("seed, most", [(1, 3), (2, 100)])
def test_any_cut_with_repeats_and_late_batches(spark, tmp_path, seed, most):
    at, rng, all_ = f"file://{tmp_path}/t", random.Random(seed), events(seed)
    mixed = rng.sample(all_, len(all_))  # late events: no order at all
    cuts = sorted(rng.sample(range(1, len(mixed)), 6))
    batches = [mixed[a:b] for a, b in zip([0, *cuts], [*cuts, len(mixed)], strict=True)]
    for k, b in enumerate(batches):
        df = spark.createDataFrame(b + batches[k // 2][:5], EVENTS)
        assert job_table.apply(df, at, k, most_deltas=most)
        assert not job_table.apply(df, at, k, most_deltas=most)  # the same batch again
    assert rows(job_table.read(spark, at)) == rows(jobs.current(spark.createDataFrame(all_, EVENTS)))
    m = job_table.manifest(spark, at)
    assert len(m.deltas) < most and (m.snapshot is None) == (most == 100)
    job_table.compact(spark, at)
    assert rows(job_table.read(spark, at)) == rows(jobs.current(spark.createDataFrame(all_, EVENTS)))
    assert spark.read.parquet(f"{at}/{job_table.manifest(spark, at).snapshot}").count() == len({e[0] for e in all_})  # jobs, not history


def test_a_new_column_a_cut_off_write_and_old_versions(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        job_table.read(spark, at)
    one = spark.createDataFrame([("a", 1, "queued"), (None, 2, "lost")], "id string, seq bigint, state string")
    job_table.apply(one, at, 0, source="a", most_deltas=1)
    before = job_table.read(spark, at)
    more = spark.createDataFrame([("a", 5, None, "e"), ("b", 6, "ready", None)], "id string, seq bigint, state string, error_summary string")
    job_table.apply(more, at, 0, source="b", most_deltas=1)
    assert sorted(map(tuple, job_table.read(spark, at).collect())) == [("a", "queued", "e"), ("b", "ready", None)]
    assert [tuple(r) for r in before.collect()] == [("a", "queued")]  # the version it was read at is still there
    one.select("id", "seq", "state").write.parquet(f"{at}/delta-cutoff")
    assert job_table.sweep(spark, at) == 1 and job_table.sweep(spark, at) == 0
    assert job_table.read(spark, at).count() == 2 and "delta-cutoff" not in files.names(spark, at)


def test_a_stream_keeps_the_table_across_restarts(spark, tmp_path):
    at, all_ = f"file://{tmp_path}", events(3, 90)
    for k in range(3):
        spark.createDataFrame(all_[k * 30 : k * 30 + 30], EVENTS).coalesce(1).write.parquet(f"{at}/in/{k}")
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{at}/in/*")
        q = job_table.keep(stream, f"{at}/t", f"{at}/check", most_deltas=2).trigger(availableNow=True).start()
        q.awaitTermination(100)
        assert q.exception() is None
    assert rows(job_table.read(spark, f"{at}/t")) == rows(jobs.current(spark.createDataFrame(all_, EVENTS)))
    assert job_table.manifest(spark, f"{at}/t").batches == {"stream": 2}


def reports(seed, n=200):
    rng, t = random.Random(seed), datetime(2026, 1, 1)
    out = []
    for _ in range(n):
        t += timedelta(seconds=rng.choice([0, 0, 1, 2, 5, 9]), microseconds=rng.choice([0, 0, 1]))
        out.append((f"j{rng.choice([0, 0, 1, 2, 3])}", t))
    return out


def plain_edits(rows, seconds):
    last, out = {}, []
    for i, t in sorted(rows, key=lambda r: r[1]):
        if i not in last or t - last[i] >= timedelta(seconds=seconds):
            last[i] = t
            out.append((i, t))
    return sorted(out)


def test_status_edits_in_one_pass_and_as_a_stream(spark, tmp_path):
    all_ = reports(1)
    df = spark.createDataFrame([*all_, ("j9", None), (None, all_[0][1])], "id string, at timestamp")
    assert sorted(map(tuple, jobs.status_edits(df, 5).collect())) == plain_edits(all_, 5)
    assert jobs.status_edits(df.limit(0), 5).count() == 0
    for k in range(4):
        spark.createDataFrame(all_[k * 50 : k * 50 + 50], "id string, at timestamp").coalesce(1).write.parquet(f"file://{tmp_path}/in/{k}")
        stream = spark.readStream.schema("id string, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in/*")
        if k in (1, 3):  # twice, the second time from the checkpoint
            q = throttle.status_edits(stream, 5).writeStream.option("checkpointLocation", f"file://{tmp_path}/check").trigger(availableNow=True)
            q = q.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"file://{tmp_path}/out/{n}")).start()
            q.awaitTermination(100)
            assert q.exception() is None
    got = spark.read.option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/out")
    assert sorted(map(tuple, got.select("id", F.col("at")).collect())) == plain_edits(all_, 5)

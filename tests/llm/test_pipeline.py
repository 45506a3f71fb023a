import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from varaq.llm import byte_bpe, minhash, mixing, pii, quality

pytest.importorskip("public_tokenizers")


def test_stages_are_those_of_the_plan():
    assert [f for _, f in corpus_pipeline.STAGES] == [quality.keep_good, minhash.keep_one_of_each, pii.sanitise, mixing.in_mixed_order, byte_bpe.tokenise]


def test_run_equals_the_operators_one_after_the_other(spark, sf):
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r.doc_id for r in quality.assess(docs, labels).where("kept").collect()}
    some = docs.where(F.col("doc_id").isin(sorted(kept)))
    one = {r.doc_id for r in minhash.near_duplicates(some).where("kept").collect()}
    assert set(out) == one and 0 < len(one) < docs.count()
    clean = {r.doc_id: r.text for r in pii.sanitise(spark, some.where(F.col("doc_id").isin(sorted(one))), sf).collect()}
    bpe = byte_bpe.ByteBpe(*byte_bpe.read_vocabulary())
    ids = dict(zip(clean, bpe.encode_batch([t or "" for t in clean.values()]), strict=True))
    for k, t in clean.items():
        assert bytes(out[k].ids) == ids[k] and out[k].n_tokens * 4 == len(ids[k])
        assert out[k].ids_sha256 == hashlib.sha256(ids[k]).hexdigest() and out[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_each_stage_but_the_last_returns_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).dtypes == docs.dtypes


def test_positions_follow_the_mix(spark, sf):
    """Each prefix of the result, up to the horizon, holds the target weights; without the mixing stage none does."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf).orderBy("position").collect()
    assert [r.position for r in out] == list(range(len(out))) and len(out) > 100
    kept = docs.where(F.col("doc_id").isin([r.doc_id for r in out]))
    mix = mixing.mixed(kept).orderBy("_slot", "_place").collect()
    assert [r.doc_id for r in out] == [r.doc_id for r in mix]
    assert [r.doc_id for r in out] != [r.doc_id for r in kept.collect()]


def test_positions_do_not_depend_on_how_files_are_dealt_to_tasks(spark, tmp_path):
    path = f"file://{tmp_path}/docs"
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("many words "), (F.col("id") % 90 * F.col("id")).cast("int")).alias("text"))
    rows.repartitionByRange(12, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    out = byte_bpe.tokenise(spark, spark.read.parquet(path), "").collect()
    assert [r.doc_id for r in out] != list(range(400)) and all(r.position == r.doc_id for r in out) and len(out) == 400


def test_run_on_odd_documents_and_leaves_only_its_result(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, extra columns with clashing names; then no rows at all."""
    import os

    from tests.llm.fixtures import documents

    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    for name, docs in (("odd", documents(spark)), ("none", documents(spark).limit(0))):
        docs.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(k, k % 2) for k in range(0, 60, 3)], "doc_id bigint, quality int").write.parquet(f"file://{tmp_path}/{name}/labels.parquet")
        before = set(os.listdir(shared))
        out = corpus_pipeline.run(spark, f"file://{tmp_path}/{name}").collect()
        assert sorted(r.position for r in out) == list(range(len(out))) and (len(out) > 20 or name == "none")
        left = set(os.listdir(shared)) - before
        assert len(left) == 1 and os.listdir(f"{shared}/{left.pop()}") == ["4-byte_bpe"]
        docs = spark.read.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        good = quality.assess(docs, spark.read.parquet(f"file://{tmp_path}/{name}/labels.parquet")).where("kept").select("doc_id").distinct()
        some = docs.join(good, "doc_id", "left_semi")
        kept = sorted(r.doc_id for r in minhash.near_duplicates(some).where("kept").collect())
        assert sorted(r.doc_id for r in out if r.doc_id is not None) == kept

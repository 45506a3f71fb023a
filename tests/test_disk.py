"""What the chain moves, keeps and writes does not exceed its texts by much."""

import os

from tests.test_dealt import plan
from varaq.plans import engine, inputs, queries


def exchanges(df):
    return [x for x in plan(df).split("\n") if "Exchange hashpartitioning" in x]


def test_what_is_joined_by_page_stays_where_texts_were_dealt(spark, sf):
    """Lines meet their tables, pages their lists and answers, blocks their pages without a further exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        found = exchanges(queries.QUERIES["q_page_blocks"](spark, sf))
        assert found and all("REPARTITION_BY_NUM" in x for x in found), found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_page_text_is_stored_once_not_with_each_block(spark, sf, tmp_path):
    """Rows carry the text of their page; tasks are so small that a file's dictionary holds its texts."""
    d = spark.read.parquet(f"{sf}/documents.parquet")
    copies = d.crossJoin(spark.range(12).withColumnRenamed("id", "copy")).selectExpr("doc_id + copy * 50000 as doc_id", "concat(copy, ' ', text) as text", "lang", "source", "n_chars")
    copies.write.parquet(f"{tmp_path}/in/documents.parquet")
    texts = spark.read.parquet(f"{tmp_path}/in/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    assert texts > 8 * inputs.CARRIED_CHARS  # several tasks, and more than the test's four partitions could hold
    queries.QUERIES["q_json_document"](spark, f"{tmp_path}/in").write.parquet(f"{tmp_path}/out")
    written = sum(e.stat().st_size for e in os.scandir(f"{tmp_path}/out") if e.name.endswith(".parquet"))
    assert written < 3 * texts, (written, texts)


def test_concepts_are_dealt_out_before_they_meet_the_edges_of_their_book(spark, sf):
    """All rows of a list that is spelled out are held until its step has joined them, each with all edges of its book."""
    p = plan(queries.QUERIES["q_graph_json"](spark, sf)).split("\n")
    at = {k: next(n for n, x in enumerate(p) if k in x) for k in ("Join [book", "Exchange rangepartitioning(book", "Generate explode")}
    assert at["Join [book"] < at["Exchange rangepartitioning(book"] < at["Generate explode"] and "REPARTITION_BY_NUM" in p[at["Exchange rangepartitioning(book"]]


def test_a_document_is_put_together_in_a_text_of_just_its_length(spark, sf):
    """By the last aggregation, with no filter above it, which would copy the row."""
    lib = engine.run(queries._library(spark, sf))
    p = plan(lib["markdown"]).split("\n")
    last = next(k for k, x in enumerate(p) if "Aggregate" in x)
    assert not any("Filter" in x for x in p[:last]) and "concat_ws" in lib["markdown"]._jdf.queryExecution().optimizedPlan().toString()
    lib.release()


def test_blocks_that_one_stage_reads_are_not_kept(spark, sf):
    lib = queries._pages(spark, sf)
    assert not lib["blocks"].is_cached and not lib["pages"].is_cached and lib["lines"].is_cached
    assert not lib["lines"].storageLevel.useMemory
    lib.release()

"""What is dealt out by page before it grows stays where it is; what tasks hold does not grow with the input."""

import re

from pyspark.sql import functions as F

from varaq.operators import lines
from varaq.plans import engine, inputs, queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved(spark, df):
    """Bytes that a run of df shuffles, and that it spills, by Spark's own counts of its stages."""
    def counts():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {(s.stageId(), s.attemptId()): (s.shuffleWriteBytes(), s.diskBytesSpilled()) for s in map(stages.apply, range(stages.size()))}

    before = counts()
    df.write.format("noop").mode("overwrite").save()
    new = [v for k, v in counts().items() if k not in before]
    return sum(x for x, _ in new), sum(x for _, x in new)


def test_texts_are_dealt_out_and_words_stay(spark, sf):
    """One exchange in all, of texts by page, below the words; so for lines, page texts and regions."""
    for name in ("q_lines", "q_page_text", "q_region_text"):
        p = plan(queries.QUERIES[name](spark, sf))
        assert p.count("Exchange") == 1 and "hashpartitioning(book" in p and p.index("Exchange") > p.rindex("Generate")


def test_regions_move_less_than_their_texts(spark, sf, tmp_path):
    """Bytes shuffled are fewer than those of the texts, whatever the size."""
    d = spark.read.parquet(f"{sf}/documents.parquet").cache()
    volume = d.selectExpr("sum(octet_length(text))").first()[0]
    for n in (1, 4):
        copies = d.crossJoin(spark.range(n).withColumnRenamed("id", "copy")).selectExpr("doc_id + copy * 50000 as doc_id", "text", "lang", "source", "n_chars")
        copies.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        df = queries.QUERIES["q_region_text"](spark, f"{tmp_path}/{n}")
        assert df.count() >= n * d.count()
        shuffled, spilled = moved(spark, df)
        assert 0 < shuffled < n * volume and spilled == 0, (n, shuffled, volume, spilled)
    d.unpersist()


def test_words_meet_their_cells_where_they_are(spark, sf):
    """Where boxes are too many for all tasks: texts and pages are dealt out alike, and neither words nor their lines move."""
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries.QUERIES["q_cell_words"](spark, sf)
        p = plan(df)
        assert p.count("Exchange") == p.count("Exchange hashpartitioning(book") == p.count("REPARTITION_BY_NUM") == 2 and "Join" in p
        assert moved(spark, df)[0] < spark.read.parquet(f"{sf}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_lines_are_not_gathered_by_book(spark, sf):
    p = plan(queries.QUERIES["q_classify"](spark, sf))
    assert "BroadcastHashJoin" in p and p.count("Exchange hashpartitioning") == 1


def test_words_are_grouped_without_fonts_and_inks(spark, sf):
    partial = [x for x in plan(lines.lines_of(inputs.words(spark, sf))).split("\n") if "partial_collect_list" in x]
    assert partial and "fontname" not in partial[0] and "color" not in partial[0]


def test_tasks_grow_in_number(spark):
    t = spark.range(1000).select("id", F.lit("x" * 100).alias("text"))
    assert inputs.dealt(t, ("id",), "length(text)", 1000).rdd.getNumPartitions() == 100
    assert inputs.dealt(t.where("false"), ("id",), "length(text)", 1000).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_rows_that_are_spelled_out_do_not_carry_a_book_or_a_page(spark, sf):
    """What a Generate passes on with each of its rows: names and numbers, never all edges of a book or the text of a page."""
    for name, of in (("q_graph_json", "concepts"), ("q_json_document", "blocks")):
        p = plan(queries.QUERIES[name](spark, sf))
        spelled = [x for x in p.split("\n") if re.search(rf"Generate explode\w*\([^ ]*{of}", x)]
        carried = {c.split("#")[0].strip().removeprefix("_extract_") for x in spelled for c in re.search(r", \[([^\]]*)\], (?:true|false), \[", x)[1].split(",")}
        assert spelled and carried <= {"book", "page", "book_title", "version"} and "Join" in p, (name, spelled)


def test_grids_are_dealt_out_by_page_and_their_cells_stay(spark, sf):
    p = plan(queries.QUERIES["q_table_stats"](spark, sf))
    assert p.count("Exchange") == 1 and "hashpartitioning(book" in p and p.index("Exchange") > p.rindex("Generate")


def test_books_of_lines_may_be_compressed(spark, sf, tmp_path):
    from varaq.sources import book_pages

    folder = queries._line_books(spark, sf)
    got = book_pages.read_pages(spark, folder, "words", opener="lines", max_pages=1 << 30)
    assert got.count() == inputs.words(spark, sf).count() and all(".gz" in x for x in spark.read.text(folder).inputFiles())


def test_texts_and_blocks_read_the_same_lines(spark, sf, monkeypatch):
    """Words are put together to lines in one place of the plan, and kept; texts made them anew."""
    made, whole = [], lines.lines_of
    monkeypatch.setattr(lines, "lines_of", lambda *a: made.append(whole(*a)) or made[-1])
    lib = queries._pages(spark, sf)
    assert len(made) == 1 and lib["lines"].is_cached
    assert "InMemoryTableScan" in plan(lines.page_texts(lib["lines"]))
    lib.release()


def test_no_join_holds_the_text_of_a_book(spark, sf):
    """A book's Markdown is put together by the last step of its plan, and nothing is added to it after that."""
    lib = engine.run(queries._library(spark, sf))
    p = plan(lib["markdown"]).split("\n")
    last = next(k for k, x in enumerate(p) if "Aggregate" in x)
    assert not any("Join" in x or "concat(" in x for x in p[:last]) and not any("Exchange" in x for x in p[:last])
    lib.release()

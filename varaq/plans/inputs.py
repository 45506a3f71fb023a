"""Inputs that the registered queries derive from the driver's tables, in Spark and as DuckDB common table
expressions. Texts are made Persian letter by letter, so that every operator meets its own script."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varaq.functions.text import CHAPTER, LESSON, ORDINALS

AZ = "abcdefghijklmnopqrstuvwxyz"
FA = "ابپتثجچحخدذرزژسشصضطظعغيكةى"
MIXED = "۰۱۲3456٧٨٩"

#: Expressions that both engines read alike.
FA_TEXT = (
    f"concat(translate(lower(text), '{AZ}', '{FA}'), case when doc_id % 5 = 0 then '\n۱۲ - ۳\n.\n' else '' end, "
    "case when doc_id % 7 = 0 then ' )12( ]ab[ }x{ ' else '' end, case when doc_id % 3 = 0 then '\tـ\t  x\r\n\n\ny' else '' end, "
    "case when doc_id % 4 = 0 then ' ??' else '' end)"
)
TOKEN = (
    f"case when (doc_id + pos) % 6 = 0 then translate(lower(w), '{AZ}', '{FA}') "
    f"when (doc_id + pos) % 6 = 1 then concat('(', translate(concat(pos, ''), '0123456789', '{MIXED}'), ').') "
    "when (doc_id + pos) % 6 = 2 then concat(w, '‌') when (doc_id + pos) % 6 = 3 then concat(pos * 7, '٫۵') else w end"
)
_WORD = f"case when tok % 4 < 2 then translate(lower(w), '{AZ}', '{FA}') else w end"


def ordinal_case(number: str) -> str:
    first = {v: k for k, v in reversed(ORDINALS.items())}
    return f"case {number} " + " ".join(f"when {v} then '{k}'" for v, k in sorted(first.items())) + " else 'بیست‌ویکم' end"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores where a scan has few splits: texts are costly to work on, and one row group is one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def documents_fa(spark, sf) -> DataFrame:
    return spread(read(spark, sf, "documents")).select("doc_id", "source", F.expr(FA_TEXT).alias("text"))


def tokens(spark, sf) -> DataFrame:
    """Distinct tokens of all texts."""
    t = spread(read(spark, sf, "documents")).select("doc_id", F.posexplode(F.split(F.translate("text", "\n", " "), " ")).alias("pos", "w"))
    return t.select(F.expr(TOKEN).alias("w")).distinct()


#: Beside its whole texts, every book has short pages: the first words of some pages once more.
SHORT = 1_000_000
#: Characters of texts that one task spells into words: what it sorts of them stays in its memory.
TASK_CHARS = 6_000_000
#: Characters of texts in a task whose rows carry the text of their page: they fit into the dictionary of a Parquet file (1 MB,
#: Persian letters are two bytes), so that a text is stored once and not with each of its page's blocks.
CARRIED_CHARS = 400_000
#: Parts whose grids one task spells into cells.
TASK_PARTS = 20_000
#: Characters of edges that one task shows beside its concepts, and that are sent to all tasks at most.
TASK_EDGE_CHARS, SENT_CHARS = 256_000_000, 64_000_000
_SHORT_OF = "page % 9 = 0 and word_no < page % 7"


def words(spark, sf, volume: Column | None = None) -> DataFrame:
    """volume: of pages that are to lie together; it is a further column then."""
    return _spelled(_page_texts(spark, sf, volume))


def words_and_boxes(spark, sf) -> tuple[DataFrame, DataFrame]:
    """words() and cell_boxes(), both dealt by page to the same tasks: words meet their cells where their texts are spelled."""
    texts = _texts(spark, sf)
    n = tasks_for(texts, "length(text)", TASK_CHARS)
    return _spelled(texts.repartition(n, "book", "page")), cell_boxes(spark, sf, n)


def books(spark, sf, most: int = TASK_CHARS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """words(), page_cells() and listed(), all dealt by page to the same tasks: what is joined by page stays there. most:
    characters a task."""
    texts = _texts(spark, sf)
    n = tasks_for(texts, "length(text)", most)
    return _spelled(texts.repartition(n, "book", "page")), page_cells(spark, sf, n), listed(spark, sf).repartition(n, "book", "page")


def listed(spark, sf) -> DataFrame:
    """All pages of the books; some without words, some whose words could not be read (with or without words that must
    not count), some whose tables could not, some of whose words no text could be made."""
    d = read(spark, sf, "documents").select(F.col("source").alias("book"), (F.col("doc_id") + 1).cast("int").alias("page"))
    more = d.where("page % 25 = 0").withColumn("page", (F.col("page") + 2 * SHORT).cast("int"))
    none = F.lit(None).cast("string")
    own = d.select("*", F.expr("case when page % 37 = 0 then 'broken words' end").alias("error"), F.expr("case when page % 31 = 0 then 'no tables' end").alias("structure_error"), F.expr("case when page % 41 = 0 then 'no text' end").alias("text_error"))
    return own.unionByName(more.select("*", F.expr("case when page % 50 = 0 then 'broken page' end").alias("error"), none.alias("structure_error"), none.alias("text_error")))


def page_cells(spark, sf, tasks: int | None = None) -> DataFrame:
    """A table of two rows on some pages of words(). tasks: pages are dealt out to so many before they have cells."""
    d = read(spark, sf, "documents").where("doc_id % 6 = 0").select(F.col("source").alias("book"), (F.col("doc_id") + 1).cast("int").alias("page"))
    d = d if tasks is None else d.repartition(tasks, "book", "page")
    g = d.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("row_no")).select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("col_no"))
    text = "case when (page + row_no * col_no) % 3 = 0 or page % 4 = 0 and col_no > 1 then '' else concat('c', row_no, '|', col_no, ' ', page) end"
    box = {"table_x0": 0.0, "table_top": 30.0, "table_x1": 100.0, "table_bottom": 60.0, "page_w": 600.0, "page_h": 800.0}
    return g.select("book", "page", F.lit(1).alias("table_no"), "row_no", "col_no", F.expr(text).alias("text"), F.expr("30e0 + row_no").alias("top"), *(F.lit(v).alias(k) for k, v in box.items()))




def tasks_for(df: DataFrame, size: str, most: int) -> int:
    """So many tasks that each has about `most` of the sum of `size`."""
    total = df.agg(F.expr(f"sum({size})")).first()[0] or 0
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-total // most))


def dealt(df: DataFrame, keys: tuple[str, ...], size: str, most: int) -> DataFrame:
    """Rows dealt out by keys, to so many tasks that each has about `most` of the sum of `size`, so that what a task holds
    does not grow with the input. What is grouped by these keys later on, by others beside them too, stays where it is."""
    return df.repartition(tasks_for(df, size, most), *keys)


def _texts(spark, sf) -> DataFrame:
    """book, page, text of the whole pages and of the short ones, of which the first line is enough; own is the number of
    the whole page."""
    d = read(spark, sf, "documents").select(F.col("source").alias("book"), (F.col("doc_id") + 1).cast("int").alias("page"), "text")
    d = d.select("*", F.col("page").alias("own"), F.lit(False).alias("short"))
    short = d.where("page % 9 = 0").withColumns({"page": (F.col("page") + SHORT).cast("int"), "text": F.substring_index("text", "\n", 1), "short": F.lit(True)})
    return d.unionByName(short)


def _page_texts(spark, sf, volume: Column | None = None) -> DataFrame:
    """Texts dealt out by page before they are words, which are many times larger."""
    both = _texts(spark, sf)
    if volume is not None:
        return dealt(both.withColumn("volume", volume), ("book", "volume"), "length(text)", TASK_CHARS)
    return dealt(both, ("book", "page"), "length(text)", TASK_CHARS)


def _spelled(pages: DataFrame) -> DataFrame:
    keys = [c for c in ("book", "volume", "page") if c in pages.columns]
    t = pages.select(*keys, "own", "short", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    t = t.select(*keys, "own", "short", "ln", F.posexplode(F.split("line", " ")).alias("tok", "w")).where("w <> '' and (not short or ln * 100000 + tok < own % 7)")
    t = t.withColumn("vl", F.expr("ln * 2000 + tok div 12"))
    top = F.expr("vl * 12e0 + (tok % 3) / 2e0")
    x0 = F.expr("500e0 - (tok % 12) * 7e0")
    return t.select(
        *keys,
        F.expr("ln * 100000 + tok").alias("word_no"),
        F.expr(_WORD).alias("text"),
        x0.alias("x0"),
        (x0 + 6).alias("x1"),
        top.alias("top"),
        (top + 9).alias("bottom"),
        F.expr("case when (vl + own) % 11 = 5 then null when (vl + own) % 7 = 0 then 30e0 when (vl + own) % 7 = 3 then 14e0 else 12e0 end").alias("size"),
        F.expr("case vl % 4 when 0 then 'Naz-BOLD' when 1 then 'Nazanin' else null end").alias("fontname"),
        F.expr(
            "case vl % 5 when 0 then array(0.9e0, 0.1e0, 0.1e0) when 1 then array(0.1e0, 0.12e0, 0.11e0) when 2 then array(0.5e0) when 3 then null "
            "else array(0e0, 0.6e0, 0.9e0, 0e0) end"
        ).alias("color"),
    )


def cells(spark, sf) -> DataFrame:
    """A grid for each part, on a page of its own in its brand's book; some of them sparse, empty, flat or false."""
    p = read(spark, sf, "part").select("p_partkey", "p_name", F.col("p_brand").alias("book"), F.col("p_partkey").cast("int").alias("page"))
    p = dealt(p, ("book", "page"), "1", TASK_PARTS)
    g = p.select("*", F.explode(F.expr("sequence(1, cast(1 + p_partkey % 4 as int))")).alias("row_no"))
    g = g.select("*", F.explode(F.expr("sequence(1, cast(1 + (p_partkey div 4) % 3 as int))")).alias("col_no"))
    text = (
        "case when p_partkey % 13 = 0 then '' when (p_partkey * 7 + row_no * 3 + col_no * 5) % (2 + p_partkey % 3) = 0 then case when p_partkey % 2 = 0 then null else ' ' end "
        f"when p_partkey % 10 = 6 and row_no = 1 and col_no = 1 then repeat('x\n', 17) else translate(p_name, '{AZ}', '{FA}') end"
    )
    return g.select(
        "book",
        "page",
        F.lit(1).alias("table_no"),
        "row_no",
        "col_no",
        F.expr(text).alias("text"),
        F.expr("case when (row_no + p_partkey) % 5 = 0 then null else row_no * 12e0 end").alias("top"),
        F.lit(0.0).alias("table_x0"),
        F.lit(10.0).alias("table_top"),
        F.expr("50e0 + p_partkey % 60").alias("table_x1"),
        F.lit(100.0).alias("table_bottom"),
        F.lit(110.0).alias("page_w"),
        F.lit(100.0).alias("page_h"),
    )


def cell_lines(spark, sf) -> DataFrame:
    """Classified lines on the pages of cells(): some in their table's rows, some not."""
    p = read(spark, sf, "part").select("*", F.explode(F.expr("sequence(0, 14)")).alias("k"))
    return p.select(
        F.col("p_brand").alias("book"),
        F.col("p_partkey").cast("int").alias("page"),
        F.expr("k * 12e0").alias("band"),
        F.expr("case when k % 7 = 6 then ' ' else concat(p_name, ' ', k) end").alias("text"),
        F.expr("k * 12e0").alias("top"),
        F.expr("k * 12e0 + 9e0").alias("bottom"),
        F.expr("case when (p_partkey + k) % 5 = 0 then 'heading' else 'paragraph' end").alias("type"),
        F.expr("case when (p_partkey + k) % 5 = 0 then 0.65e0 else 1e0 end").alias("confidence"),
        F.lit("body_text").alias("reason"),
    )


def page_ocr(texts: DataFrame) -> DataFrame:
    """Answers of recognition for short pages: better, worse, failed."""
    return texts.where(F.length("text") < 30).select(
        "book",
        "page",
        F.expr("case page % 4 when 0 then 'x' when 1 then null else concat(repeat('کتاب ', page % 9 + 1), text) end").alias("text"),
        F.expr("case when page % 5 = 0 then null else 40e0 + page % 10 + 0.25e0 end").alias("confidence"),
        F.expr("case page % 4 when 1 then 'engine stopped' else null end").alias("error"),
    )


_PAGE_NO = "translate(concat({0}, ''), '0123456789', '" + MIXED + "')"
_TOC = {
    "chapter": f"concat('{CHAPTER} ', {ordinal_case('k + 1')}, ': ', translate(lower(name), '{AZ}', '{FA}'), ' ..... ', {_PAGE_NO.format('k * 30 + 1')})",
    "lesson": f"concat('{LESSON} ', {ordinal_case('n + 1')}, ' : ', translate(lower(name), '{AZ}', '{FA}'), '.... ', {_PAGE_NO.format('n * 6 + 2')})",
    "wrapped": "case when n % 4 = 1 then concat('ها ', k) else '' end",
    "subtopic": f"concat(translate(lower(name), '{AZ}', '{FA}'), case when s % 9 = 4 then '' else ' ...' end, {_PAGE_NO.format('s % 100 + 3')}, ' ')",
}
_LOST = "case when k = 4 and contains(line, ' ..... ') then replace(line, ' ..... ', ' ') else line end"


def toc(spark, sf) -> DataFrame:
    """book, page, line_no, line: regions as chapters, nations as lessons, suppliers as subtopics. In one of the two
    books the last chapter's line has lost its page number."""
    r = read(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.lit(0).alias("n"), F.lit(0).alias("s"), F.col("r_name").alias("name"))
    n = read(spark, sf, "nation").select(F.col("n_regionkey").alias("k"), F.col("n_nationkey").alias("n"), F.lit(0).alias("s"), F.col("n_name").alias("name"))
    s = read(spark, sf, "supplier").select((F.col("s_nationkey") % 5).alias("k"), F.col("s_nationkey").alias("n"), F.col("s_suppkey").cast("int").alias("s"), F.col("s_name").alias("name"))
    at = lambda df, kind, place: df.select("k", F.expr(place).cast("bigint").alias("line_no"), F.expr(_TOC[kind]).alias("line"))
    lines = (
        at(r, "chapter", "cast(k as bigint) * 1000000000")
        .union(at(n, "wrapped", "cast(k as bigint) * 1000000000 + (n + 1) * 10000000 - 1"))
        .union(at(n, "lesson", "cast(k as bigint) * 1000000000 + (n + 1) * 10000000"))
        .union(at(s, "subtopic", "cast(k as bigint) * 1000000000 + (n + 1) * 10000000 + s + 1"))
    )
    title = spark.createDataFrame([(0, -1, "فهرست")], "k int, line_no bigint, line string")
    lines = title.union(lines)
    page = F.lit(2).alias("page")
    return lines.select(F.lit("a").alias("book"), page, "line_no", "line").union(lines.select(F.lit("b").alias("book"), page, "line_no", F.expr(_LOST).alias("line")))


def label_blocks(spark, sf) -> DataFrame:
    """Headings in the body: most eight pages behind the printed page, some nine."""
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("n"))
    h = n.select(F.expr("n * 6 + 2 + case when n % 5 = 3 then 9 else 8 end").alias("page"), F.lit(1).alias("block_index"), F.lit("heading").alias("type"), F.expr(f"concat('{LESSON} ', {ordinal_case('n + 1')}, '\nx')").alias("text"))
    return h.select(F.lit("a").alias("book"), "*").union(h.select(F.lit("b").alias("book"), "*"))


def book_pages(spark, sf) -> DataFrame:
    p = read(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("page"), F.expr("case when p_partkey % 6 = 0 then '' else p_name end").alias("text"))
    return p.select(F.lit("a").alias("book"), "*").union(p.select(F.lit("b").alias("book"), (F.col("page") + 3).alias("page"), "text"))


_CONCEPT = (
    "concat('{\"id\": \"', case when p_partkey % 17 = 0 then '' else concat('c', p_partkey) end, '\", \"title\": ', case when p_partkey % 19 = 0 then 'null' else concat('\"', p_name, '\"') end, "
    "', \"confidence_score\": ', case p_partkey % 4 when 0 then '0' when 1 then 'null' when 2 then '0.25' else '1.5' end, '}')"
)
_TYPES = "case p_partkey % 5 when 0 then 'related' when 1 then 'parent' when 2 then 'cause' when 3 then 'opposite' else 'child' end"
_EDGE = (
    "concat('{\"source_concept_id\": \"c', p_partkey, '\", \"target_concept_id\": \"c', case when p_partkey % 3 = 0 then p_partkey + 1 else p_partkey end, '\", \"relation_type\": \"', "
    f"{_TYPES}, '\", \"notes\": null}}')"
)


def responses(spark, sf) -> DataFrame:
    p = read(spark, sf, "part").select(F.col("p_brand").alias("book"), F.expr("cast(p_partkey % 20 as int)").alias("lesson_order"), "p_partkey", F.expr(_CONCEPT).alias("c"), F.expr(_EDGE).alias("e"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", c))), lambda x: x[c]), ", ")
    g = p.groupBy("book", "lesson_order").agg(joined("c").alias("c"), joined("e").alias("e"))
    return g.select("book", "lesson_order", F.concat(F.lit('{"concepts": ['), "c", F.lit('], "relationships": ['), "e", F.lit("]}")).alias("response"))


def cell_boxes(spark, sf, tasks: int | None = None) -> DataFrame:
    """Two by three cells over the top left of each page. tasks: pages are dealt out to so many before they have cells."""
    d = read(spark, sf, "documents").select(F.col("source").alias("book"), (F.col("doc_id") + 1).cast("int").alias("page"))
    d = d if tasks is None else d.repartition(tasks, "book", "page")
    g = d.select("*", F.lit(1).alias("table_no"), F.explode(F.expr("sequence(1, 2)")).alias("row_no")).select("*", F.explode(F.expr("sequence(1, 3)")).alias("col_no"))
    return g.select(
        "book", "page", "table_no", "row_no", "col_no", F.expr("400e0 + col_no * 30").alias("x0"), F.expr("430e0 + col_no * 30").alias("x1"), F.expr("(row_no - 1) * 24e0").alias("top"), F.expr("row_no * 24e0").alias("bottom")
    )


def job_events(spark, sf) -> DataFrame:
    """Partial updates of jobs, several an id, in the order of seq."""
    e = read(spark, sf, "events")
    return e.select(
        (F.col("event_id") % 701).alias("id"),
        F.col("event_id").alias("seq"),
        F.expr("case when event_id % 3 = 0 then null else event_type end").alias("state"),
        F.expr("case when event_id % 4 = 0 then cast(event_id % 50 as int) end").alias("total_pages"),
        F.expr("case when event_id % 9 = 2 then concat('e', event_id) end").alias("error_summary"),
    )


def job_files(spark, sf) -> DataFrame:
    e = read(spark, sf, "events")
    return e.select(
        F.expr("concat('j', event_id)").alias("id"),
        F.expr("case when event_id % 3 = 0 then null else concat('/in/j', event_id, '-book.pdf') end").alias("local_input_path"),
        F.expr("array(concat('/out/j', event_id, '-a.json'), concat('/out/x', event_id, '.md'), concat('/tmp/j', event_id, '-b'), concat('/out/../j', event_id, '-c'))").alias("output_paths"),
    )


_STATE = (
    "case when event_type = 'signup' then 'queued' when event_type = 'error' then 'failed' when event_type = 'click' then 'completed' "
    "when event_type = 'purchase' then 'cancelled' when event_id % 3 = 0 then 'extracting' when event_id % 3 = 1 then 'received' else 'cancel_requested' end"
)


def jobs(spark, sf) -> DataFrame:
    e = read(spark, sf, "events").withColumn("state", F.expr(_STATE))
    end = F.expr("case when state in ('completed', 'failed', 'cancelled') and event_id % 4 <> 0 then ts + interval 90 seconds end")
    return e.select(
        F.col("event_id").alias("id"),
        "user_id",
        (F.col("event_id") % 997).alias("unique_id"),
        F.concat(F.lit("f"), F.col("event_id").cast("string"), F.lit(".pdf")).alias("filename"),
        "state",
        F.col("ts").alias("created_at"),
        F.expr("case when event_id % 5 <> 0 then ts + interval 7 seconds end").alias("started_at"),
        end.alias("completed_at"),
        F.expr("case when event_type = 'error' and event_id % 2 = 0 then 'processing failed' end").alias("error_summary"),
        F.expr("case when event_id % 3 = 0 then cast(event_id % 200 as int) end").alias("total_pages"),
        F.expr("case when event_id % 6 = 0 then cast(event_id % 100 as int) end").alias("processed_pages"),
        F.expr("case when event_id % 9 = 0 then cast(event_id % 7 as int) end").alias("ocr_page_count"),
        F.expr("case when event_id % 2 = 0 then array('a.json', 'b.md') else array('a.json', 'b.md', 'c', 'd', 'e') end").alias("output_paths"),
        F.expr("transform(sequence(1, cast(1 + event_id % 11 as int)), k -> repeat(concat('w', k), 100))").alias("warnings"),
        F.lit(False).alias("cancellation_requested"),
    )


def requests(spark, sf) -> DataFrame:
    c = read(spark, sf, "customer")
    return c.select(
        F.expr("concat('b', c_custkey)").alias("book"),
        F.expr("concat(case when c_custkey % 3 = 0 then 'in/' else '' end, c_name, case c_custkey % 6 when 5 then '.txt' when 4 then '.v2.PDF' else '.pdf' end)").alias("filename"),
        F.expr("case c_custkey % 4 when 0 then '' when 1 then null when 2 then c_name else 'a ?? b' end").alias("title"),
        F.expr("case c_custkey % 3 when 0 then '' when 1 then c_mktsegment end").alias("course"),
        F.expr("case c_custkey % 5 when 0 then '10' end").alias("grade"),
    )


def sidecars(spark, sf) -> DataFrame:
    """Some have the name of no book."""
    c = read(spark, sf, "customer")
    return c.select(
        F.expr("concat(case when c_custkey % 7 < 4 then 'b' else 'other' end, c_custkey)").alias("book"), F.expr("case c_custkey % 7 when 1 then '' else concat('side ', c_custkey) end").alias("book_title"),
        F.expr("case c_custkey % 2 when 0 then 'side course' end").alias("course"), F.lit("11").alias("grade"),
    )


def captions(spark, sf) -> DataFrame:
    """Captions around whole texts, and around a few words."""
    c = read(spark, sf, "conversations").select("conv_id", "turn", F.explode(F.array(F.lit(True), F.lit(False))).alias("whole"), "text")
    return c.select("conv_id", "turn", "whole", F.expr(CAPTION).alias("caption"))


CAPTION = (
    "case when conv_id % 11 = 0 then '' when conv_id % 13 = 0 then null else concat(' Title : ', case when whole then text else concat('کتاب ', turn) end, '\nدرس: ', conv_id, '\nکلید: x\nتعداد\ncourse: ', "
    "case when conv_id % 3 = 0 then '??' when conv_id % 3 = 1 then '' else concat('c', turn) end, '\nپایه:', conv_id % 12) end"
)


# --- the same for DuckDB ---------------------------------------------------------------------------------------------

DUCK: dict[str, tuple[tuple[str, ...], str]] = {
    "documents_fa": ((), f"select doc_id, source, {FA_TEXT} as text from documents"),
    "tokens": (
        (),
        "select distinct " + TOKEN + " as w from (select doc_id, generate_subscripts(a, 1) - 1 as pos, unnest(a) as w from (select doc_id, string_split(translate(text, '\n', ' '), ' ') as a from documents))",
    ),
    "whole_words": (
        (),
        "select book, page, ln * 100000 + tok as word_no, " + _WORD + " as text, 500e0 - (tok % 12) * 7e0 as x0, 506e0 - (tok % 12) * 7e0 as x1, vl * 12e0 + (tok % 3) / 2e0 as top, "
        "vl * 12e0 + (tok % 3) / 2e0 + 9 as bottom, case when (vl + page) % 11 = 5 then null when (vl + page) % 7 = 0 then 30e0 when (vl + page) % 7 = 3 then 14e0 else 12e0 end as size, "
        "case vl % 4 when 0 then 'Naz-BOLD' when 1 then 'Nazanin' else null end as fontname, "
        "case vl % 5 when 0 then [0.9e0, 0.1e0, 0.1e0] when 1 then [0.1e0, 0.12e0, 0.11e0] when 2 then [0.5e0] when 3 then null else [0e0, 0.6e0, 0.9e0, 0e0] end as color "
        "from (select book, page, ln, tok, w, ln * 2000 + tok // 12 as vl from (select book, page, ln, generate_subscripts(a, 1) - 1 as tok, unnest(a) as w from "
        "(select book, page, ln, string_split(line, ' ') as a from (select source as book, cast(doc_id + 1 as int) as page, generate_subscripts(b, 1) - 1 as ln, unnest(b) as line "
        "from (select source, doc_id, string_split(text, '\n') as b from documents)))) where w <> '')",
    ),
    "cells": (
        (),
        "select p_brand as book, cast(p_partkey as int) as page, 1 as table_no, row_no, col_no, "
        "case when p_partkey % 13 = 0 then '' when (p_partkey * 7 + row_no * 3 + col_no * 5) % (2 + p_partkey % 3) = 0 then case when p_partkey % 2 = 0 then null else ' ' end "
        f"when p_partkey % 10 = 6 and row_no = 1 and col_no = 1 then repeat('x\n', 17) else translate(p_name, '{AZ}', '{FA}') end as text, "
        "case when (row_no + p_partkey) % 5 = 0 then null else row_no * 12e0 end as top, 0e0 as table_x0, 10e0 as table_top, 50e0 + p_partkey % 60 as table_x1, 100e0 as table_bottom, "
        "110e0 as page_w, 100e0 as page_h from (select *, unnest(range(1, 2 + (p_partkey // 4) % 3)) as col_no from (select *, unnest(range(1, 2 + p_partkey % 4)) as row_no from part))",
    ),
    "cell_lines": (
        (),
        "select p_brand as book, cast(p_partkey as int) as page, k * 12e0 as band, case when k % 7 = 6 then ' ' else concat(p_name, ' ', k) end as text, k * 12e0 as top, k * 12e0 + 9e0 as bottom, "
        "case when (p_partkey + k) % 5 = 0 then 'heading' else 'paragraph' end as type, case when (p_partkey + k) % 5 = 0 then 0.65e0 else 1e0 end as confidence, 'body_text' as reason "
        "from (select *, unnest(range(0, 15)) as k from part)",
    ),
    "toc": (
        (),
        "select book, 2 as page, line_no, case when book = 'b' then " + _LOST + " else line end as line from (select 0 as k, -1 as line_no, 'فهرست' as line union all "
        f"select k, cast(k as bigint) * 1000000000, {_TOC['chapter']} from (select r_regionkey as k, r_name as name from region) union all "
        f"select k, cast(k as bigint) * 1000000000 + (n + 1) * 10000000 - 1, {_TOC['wrapped']} from (select n_regionkey as k, n_nationkey as n, n_name as name from nation) union all "
        f"select k, cast(k as bigint) * 1000000000 + (n + 1) * 10000000, {_TOC['lesson']} from (select n_regionkey as k, n_nationkey as n, n_name as name from nation) union all "
        f"select k, cast(k as bigint) * 1000000000 + (n + 1) * 10000000 + s + 1, {_TOC['subtopic']} from (select s_nationkey % 5 as k, s_nationkey as n, s_suppkey as s, s_name as name from supplier)) "
        ", (values ('a'), ('b')) b(book)",
    ),
    "label_blocks": (
        (),
        f"select book, n * 6 + 2 + case when n % 5 = 3 then 9 else 8 end as page, 1 as block_index, 'heading' as type, concat('{LESSON} ', {ordinal_case('n + 1')}, '\nx') as text "
        "from (select n_nationkey as n from nation), (values ('a'), ('b')) b(book)",
    ),
    "book_pages": (
        (),
        "select book, cast(p_partkey as int) + shift as page, case when p_partkey % 6 = 0 then '' else p_name end as text from part, (values ('a', 0), ('b', 3)) b(book, shift)",
    ),
    "responses": (
        (),
        "select book, lesson_order, concat('{\"concepts\": [', string_agg(c, ', ' order by p_partkey), '], \"relationships\": [', string_agg(e, ', ' order by p_partkey), ']}') as response "
        f"from (select p_brand as book, cast(p_partkey % 20 as int) as lesson_order, p_partkey, {_CONCEPT} as c, {_EDGE} as e from part) group by 1, 2",
    ),
    "jobs": (
        (),
        "select event_id as id, user_id, event_id % 997 as unique_id, concat('f', event_id, '.pdf') as filename, state, ts as created_at, case when event_id % 5 <> 0 then ts + interval 7 seconds end as started_at, "
        "case when state in ('completed', 'failed', 'cancelled') and event_id % 4 <> 0 then ts + interval 90 seconds end as completed_at, "
        "case when event_type = 'error' and event_id % 2 = 0 then 'processing failed' end as error_summary, case when event_id % 3 = 0 then cast(event_id % 200 as int) end as total_pages, "
        "case when event_id % 6 = 0 then cast(event_id % 100 as int) end as processed_pages, case when event_id % 9 = 0 then cast(event_id % 7 as int) end as ocr_page_count, "
        "case when event_id % 2 = 0 then ['a.json', 'b.md'] else ['a.json', 'b.md', 'c', 'd', 'e'] end as output_paths, "
        f"list_transform(range(1, 2 + event_id % 11), lambda k: repeat(concat('w', k), 100)) as warnings from (select *, {_STATE} as state from events)",
    ),
    "requests": (
        (),
        "select concat('b', c_custkey) as book, concat(case when c_custkey % 3 = 0 then 'in/' else '' end, c_name, case c_custkey % 6 when 5 then '.txt' when 4 then '.v2.PDF' else '.pdf' end) as filename, "
        "case c_custkey % 4 when 0 then '' when 1 then null when 2 then c_name else 'a ?? b' end as title, case c_custkey % 3 when 0 then '' when 1 then c_mktsegment end as course, "
        "case c_custkey % 5 when 0 then '10' end as grade from customer",
    ),
    "sidecars": (
        (),
        "select concat(case when c_custkey % 7 < 4 then 'b' else 'other' end, c_custkey) as book, case c_custkey % 7 when 1 then '' else concat('side ', c_custkey) end as book_title, case c_custkey % 2 when 0 then 'side course' end as course, '11' as grade "
        "from customer",
    ),
    "cell_boxes": (
        (),
        "select source as book, cast(doc_id + 1 as int) as page, 1 as table_no, row_no, col_no, 400e0 + col_no * 30 as x0, 430e0 + col_no * 30 as x1, (row_no - 1) * 24e0 as top, row_no * 24e0 as bottom "
        "from documents, (values (1), (2)) r(row_no), (values (1), (2), (3)) c(col_no)",
    ),
    "job_events": (
        (),
        "select event_id % 701 as id, event_id as seq, case when event_id % 3 = 0 then null else event_type end as state, case when event_id % 4 = 0 then cast(event_id % 50 as int) end as total_pages, "
        "case when event_id % 9 = 2 then concat('e', event_id) end as error_summary from events",
    ),
    "captions": ((), f"select conv_id, turn, whole, {CAPTION} as caption from conversations, (values (true), (false)) x(whole)"),
    "words": (("whole_words",), f"select * from whole_words union all select * replace (page + {SHORT} as page) from whole_words where {_SHORT_OF}"),
    "listed": (
        ("whole_words",),
        "select book, page, case when page % 37 = 0 then 'broken words' end as error, case when page % 31 = 0 then 'no tables' end as structure_error, case when page % 41 = 0 then 'no text' end as text_error from (select source as book, cast(doc_id + 1 as int) as page from documents) union all "
        f"select book, page + {2 * SHORT}, case when page % 50 = 0 then 'broken page' end, null, null from (select source as book, cast(doc_id + 1 as int) as page from documents) where page % 25 = 0",
    ),
    "page_cells": (
        (),
        "select book, page, 1 as table_no, row_no, col_no, case when (page + row_no * col_no) % 3 = 0 or page % 4 = 0 and col_no > 1 then '' else concat('c', row_no, '|', col_no, ' ', page) end as text, 30e0 + row_no as top, "
        "0e0 as table_x0, 30e0 as table_top, 100e0 as table_x1, 60e0 as table_bottom, 600e0 as page_w, 800e0 as page_h "
        "from (select source as book, cast(doc_id + 1 as int) as page from documents where doc_id % 6 = 0), (values (1), (2)) r(row_no), (values (1), (2), (3)) c(col_no)",
    ),
}


def with_tables(sql: str, tables: dict[str, tuple[tuple[str, ...], str]], *needed: str) -> str:
    """sql with the common table expressions that it needs in front, each after those that it needs itself."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in tables[name][0]:
                add(n)
            order.append(name)

    for n in needed:
        add(n)
    return "with " + ", ".join(f"{n} as ({tables[n][1]})" for n in order) + " " + sql if order else sql

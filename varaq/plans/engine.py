"""All stages over many books at once, from words to exports, as one plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.operators import blocks, extraction, graph, lessons, lines, outline, pages, render, tables


@dataclass
class Library:
    """Relations of a run; each stage adds its own. Those that several later stages read are persisted (on disk, so that
    the memory is for the work; recomputed where an executor is lost) until release()."""

    requests: DataFrame
    words: DataFrame
    cells: DataFrame
    #: What recognition gave, or a function that runs it on the pages that need it (book, page, text).
    ocr: DataFrame | Callable[[DataFrame], DataFrame]
    use_ocr: bool = True
    #: All pages, as operators.pages.with_all_pages() takes them; without it those that have words.
    listed: DataFrame | None = None
    relations: dict[str, DataFrame] = field(default_factory=dict)
    #: What stages keep for themselves until release().
    held: list[DataFrame] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        return self.relations[name]

    def release(self) -> None:
        for name in SHARED:
            if name in self.relations:
                self.relations[name].unpersist()
        while self.held:
            self.held.pop().unpersist()


Stage = Callable[[Library], dict[str, DataFrame]]
#: Relations that are costly to make, and the stages that read them: one that several stages of a run read is persisted.
#: Pages are read from their kept texts and answers.
SHARED = {"lines": (), "blocks": ("build_outline", "build_lessons", "export"), "outline": ("build_lessons", "export_outline")}

def kept(df: DataFrame) -> DataFrame:
    """df, persisted on disk as its rows were dealt out: what is grouped or joined by page later on stays there. Spark tells
    later plans how rows lie only if the plan of the persisted ones is settled, that is, not adaptive."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.persist(StorageLevel.DISK_ONLY)
    finally:
        conf.set("spark.sql.adaptive.enabled", before)


class Cancelled(RuntimeError):
    pass


def read_pages(lib: Library, found: DataFrame | None = None) -> DataFrame:
    """The pages with their texts and status; of the lines only the texts are kept, as recognition asks for them too.

    found: the lines of all words, where they are at hand.
    """
    texts = kept(lines.page_texts(lines.lines_of(lib.words) if found is None else found))
    lib.held.append(texts)
    if lib.listed is not None:
        texts = pages.with_all_pages(texts, lib.listed)
    ocr = lib.ocr
    if callable(ocr):  # recognition is not run again
        ocr = kept(ocr(pages.needs_ocr(texts)))
        lib.held.append(ocr)
    return pages.page_status(texts, ocr, lib.use_ocr)


def extract_pages(lib: Library) -> dict[str, DataFrame]:
    """Texts and blocks read the same kept lines; only baselines, which come before those, are of words once more."""
    styled = kept(lines.classify(lines.lines_of(lib.words)))
    status = read_pages(lib, styled)
    boxes = tables.labelled(tables.accepted(tables.table_stats(lib.cells)))
    return {"lines": styled, "pages": status, "blocks": pages.page_blocks(status, blocks.blocks_of(styled, boxes))}


def build_document(lib: Library) -> dict[str, DataFrame]:
    counts = pages.document_counts(lib["pages"])
    return {"counts": counts, "warnings": pages.document_warning(counts, lib.use_ocr)}


def build_outline(lib: Library) -> dict[str, DataFrame]:
    entries = outline.toc_entries(outline.toc_lines(outline.toc_pages(lib["pages"], lib["blocks"])))
    return {"outline": outline.outline(entries)}


def build_lessons(lib: Library) -> dict[str, DataFrame]:
    ranges = lessons.lesson_ranges(lib["outline"], lessons.offsets(lib["blocks"], lib["outline"]), lib["counts"])
    return {"lessons": lessons.lesson_extracts(ranges, lib["pages"])}


def export(lib: Library) -> dict[str, DataFrame]:
    meta = lib.requests.select("book", "filename", "title", "course", "grade")
    return {
        "json": render.json_documents(meta, lib["pages"], lib["blocks"], lib["warnings"]),
        "markdown": render.markdown_documents(meta, lib["counts"], lib["warnings"], render.markdown_pages(lib["pages"], lib["blocks"])),
    }


def export_outline(lib: Library) -> dict[str, DataFrame]:
    return {"seed": render.seed_documents(lib["outline"], lib.requests.select("book", "title", "course", "grade"))}


STAGES: tuple[tuple[str, Stage], ...] = (
    ("extract_pages", extract_pages),
    ("build_document", build_document),
    ("build_outline", build_outline),
    ("build_lessons", build_lessons),
    ("export", export),
    ("export_outline", export_outline),
)


def run(lib: Library, stages=STAGES, progress: Callable[[str], None] | None = None, cancelled: Callable[[], bool] | None = None) -> Library:
    """Add every stage's relations. Before each stage it asks whether to stop, then reports the stage."""
    read = {key: sum(name in by for name, _ in stages) for key, by in SHARED.items()}
    for name, stage in stages:
        if cancelled is not None and cancelled():
            raise Cancelled(name)
        if progress is not None:
            progress(name)
        for key, made in stage(lib).items():
            lib.relations[key] = kept(made) if read.get(key, 0) > 1 and not made.is_cached else made
    return lib


def graph_relations(lib: Library, responses: DataFrame) -> dict[str, DataFrame]:
    """Concepts and relationships of an extractor's answers; a lesson with a bad confidence is kept out whole."""
    found = graph.concepts(responses)
    bad = found.where("error is not null").select("book", "lesson_order").distinct()
    good = responses.join(bad, ["book", "lesson_order"], "left_anti")
    sources = lib["lessons"], lib.requests
    vertices, edges = graph.with_sources(graph.concepts(good), *sources), graph.with_sources(graph.relationships(good), *sources)
    meta = lib.requests.select("book", "title", "course", "grade")
    return {"concepts": vertices, "relationships": edges, "failed_lessons": bad, "graph": render.graph_documents(vertices, edges, meta)}


def with_graph(lib: Library, responses: DataFrame) -> Library:
    lib.relations |= graph_relations(lib, responses)
    return lib


def lesson_requests(lib: Library, model: str) -> DataFrame:
    """What an extractor is asked for each lesson of the library that has pages."""
    chapters = lib["outline"].where("role = 'chapter'").select("book", F.col("seq").alias("chapter_seq"), F.col("title").alias("chapter_title"))
    meta = lib.requests.select("book", F.coalesce("title", "book").alias("book_title"), "course", "grade")
    told = lessons.prompts(lib["lessons"].join(chapters, ["book", "chapter_seq"]).join(meta, "book"))
    return extraction.requests(told.withColumnRenamed("order", "lesson_order"), model)


def concept_stages(client: Callable[[], extraction.Client], log: str, model: str, **asking) -> tuple[tuple[str, Stage], ...]:
    """The stages that ask an extractor and build the graph, to follow STAGES; asking: see extraction.ask()."""

    def extract_concepts(lib: Library) -> dict[str, DataFrame]:
        spark, wanted = lib.requests.sparkSession, lesson_requests(lib, model)
        stopped = extraction.ask(wanted, log, client, **asking)
        found = extraction.outcomes(wanted, extraction.read_log(spark, log))
        bad = graph.concepts(found).where("error is not null").groupBy("book", "lesson_order").agg(F.first("error").alias("bad"))
        found = found.join(bad, ["book", "lesson_order"], "left")
        found = found.select("book", "lesson_order", "title", F.when(F.col("bad").isNull(), F.col("response")).alias("response"), F.coalesce("error", "bad").alias("error"))
        told = extraction.warnings(lib.requests.select("book"), lib["outline"], lib["lessons"], found, stopped)
        return {"asked": found, "concept_warnings": told}

    def export_knowledge_graph(lib: Library) -> dict[str, DataFrame]:
        return graph_relations(lib, lib["asked"].where("response is not null").select("book", "lesson_order", "response"))

    return ("extract_concepts", extract_concepts), ("export_knowledge_graph", export_knowledge_graph)


def summary(lib: Library, out: str = "") -> DataFrame:
    """One row a request: its names, counts, whether it has pages (ok), warnings, and the paths of its files below out."""
    role = lambda name: F.count_if(F.col("role") == name).alias(f"{name}s")
    n = lib["outline"].groupBy("book").agg(role("chapter"), role("lesson"), role("subtopic"))
    nothing = lib.requests.limit(0).select("book")
    rows = render.summaries(lib.requests.select("book", "filename", "title"), lib["counts"], n, lib.relations.get("concepts", nothing), lib.relations.get("relationships", nothing))
    said = lib["warnings"].select("book", F.lit(0).alias("k"), "warning")
    if "concept_warnings" in lib.relations:
        said = said.unionByName(lib["concept_warnings"].select("book", F.lit(1).alias("k"), "warning"))
    told = F.transform(F.array_sort(F.collect_list(F.struct("k", "warning"))), lambda x: x["warning"])
    said = said.where("warning is not null").groupBy("book").agg(told.alias("warnings"))
    rows = rows.join(said, "book", "left").withColumn("warnings", F.coalesce("warnings", F.array().cast("array<string>")))
    file = lambda kind, ending, there: F.when(there, F.concat(F.lit(f"{out}/{kind}/"), "book", F.lit(ending)))
    paths = {"json_path": ("json", ".json", F.col("ok")), "markdown_path": ("markdown", ".md", F.col("ok")), "seed_path": ("seed", ".seed.json", F.col("chapters") > 0), "graph_path": ("graph", ".graph.json", F.col("concepts") > 0)}
    return rows.withColumns({k: file(*v) for k, v in paths.items()})

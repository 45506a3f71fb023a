"""Pages with their extraction status, and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.config import SETTINGS
from varaq.functions.text import clean
from varaq.operators.lines import PAGE

EXTRACTION_FAILED, STRUCTURE_FAILED = "PAGE_EXTRACTION_FAILED: ", "BLOCK_STRUCTURING_FAILED: "
LOW, UNAVAILABLE, LOW_CONFIDENCE, RECOVERED, FAILED = "LOW_TEXT_MAY_NEED_OCR", "OCR_UNAVAILABLE_ON_THIS_MACHINE", "OCR_LOW_CONFIDENCE:", "RECOVERED_VIA_OCR", "OCR_FAILED: "


def with_all_pages(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """texts (book, page, text) with the listed pages that have no words (empty) and with what went wrong on a page.

    listed: book, page, error (its words could not be read), structure_error (its tables could not) and, if there is such
    a column, text_error (no text could be made of its words).
    """
    said = listed.select(*PAGE, *_WRONG.intersection(listed.columns))
    # a full join in two: rows of both that were dealt out by page stay where they are
    every = said.join(texts, [*PAGE], "left").unionByName(texts.join(said, [*PAGE], "left_anti"), allowMissingColumns=True)
    return every.withColumn("text", F.coalesce("text", F.lit("")))


_WRONG = {"error", "structure_error", "text_error"}


def needs_ocr(texts: DataFrame) -> DataFrame:
    """Pages to run recognition on, those without readable words among them; filter first, so that the costly step sees
    only these."""
    for c in sorted(_WRONG.intersection(texts.columns) - {"structure_error"}):
        texts = texts.withColumn("text", F.when(F.col(c).isNull(), F.col("text")).otherwise(""))
    failed = texts.where("text_error is null") if "text_error" in texts.columns else texts
    return failed.where(F.length("text") < SETTINGS.min_chars)


def page_status(texts: DataFrame, ocr: DataFrame, use_ocr: bool = True, engine: bool = True, available: bool = True) -> DataFrame:
    """texts (book, page, text) with method, needs_review and warnings.

    ocr: book, page, text, confidence, error of the pages that recognition ran on. A page with an error has no lines and
    goes on to recognition as any page with little text; one with a text_error has failed: no text, no recognition; one
    with a structure_error keeps its text and has no blocks.
    """
    for c in sorted(_WRONG.difference(texts.columns)):
        texts = texts.withColumn(c, F.lit(None).cast("string"))
    broken = F.col("text_error").isNotNull()
    texts = texts.withColumn("text", F.when(F.col("error").isNull() & ~broken, F.col("text")).otherwise(""))
    got = ocr.select(*PAGE, clean(F.col("text")).alias("ocr_text"), F.col("confidence").alias("ocr_conf"), F.col("error").alias("ocr_error"))
    p = texts.join(got, [*PAGE], "left")
    short = ~broken & (F.length("text") < SETTINGS.min_chars)
    runs = F.lit(use_ocr and engine and available)
    failed = short & runs & F.col("ocr_error").isNotNull()
    better = short & runs & F.col("ocr_error").isNull() & (F.length(F.coalesce("ocr_text", F.lit(""))) > F.length("text"))
    final = F.when(better, F.col("ocr_text")).otherwise(F.col("text"))
    warnings = F.array_compact(
        F.array(
            F.when(broken, F.concat(F.lit(EXTRACTION_FAILED), F.col("text_error"))),
            F.when(short, LOW),
            F.when(short & F.lit(use_ocr and engine and not available), UNAVAILABLE),
            F.when(better & (F.col("ocr_conf") < SETTINGS.low_confidence), F.concat(F.lit(LOW_CONFIDENCE), F.format_string("%.1f", F.bround("ocr_conf", 1)))),
            F.when(better, RECOVERED),
            F.when(failed, F.concat(F.lit(FAILED), F.col("ocr_error"))),
            F.when(~broken & ~better & (final != "") & F.col("structure_error").isNotNull(), F.concat(F.lit(STRUCTURE_FAILED), F.col("structure_error"))),
        )
    )
    return p.select(
        *PAGE,
        final.alias("text"),
        F.length(final).alias("char_count"),
        F.when(broken, "failed").when(better, "ocr_tesseract").when(final == "", "empty").otherwise("pdfplumber_positional").alias("method"),
        (~broken & (F.length(final) < SETTINGS.min_chars)).alias("needs_review"),
        warnings.alias("warnings"),
    )


def page_blocks(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """The blocks that stay: structured ones of pages read by position, one plain block of recognised pages."""
    read = pages.where((F.col("method") == "pdfplumber_positional") & ~F.exists("warnings", lambda w: w.startswith(STRUCTURE_FAILED)))
    own = blocks.join(read.select(*PAGE), [*PAGE], "left_semi")
    if "source" not in blocks.columns:
        own = own.withColumn("source", F.lit(None).cast("string"))
    plain = pages.where("method = 'ocr_tesseract' and text <> ''").select(
        *PAGE, F.lit(1).alias("block_index"), F.concat(F.col("page").cast("string"), F.lit("-1")).alias("id"), F.lit("paragraph").alias("type"), "text", F.lit("ocr_fallback").alias("source")
    )
    return own.unionByName(plain, allowMissingColumns=True)


def document_counts(pages: DataFrame) -> DataFrame:
    """One row a book: pages in all, with and without text, to review, by recognition."""
    return pages.groupBy("book").agg(
        F.count("*").alias("total_pages"),
        F.count_if(F.col("char_count") > 0).alias("with_text"),
        F.count_if(F.col("char_count") == 0).alias("without_text"),
        F.count_if("needs_review").alias("to_review"),
        F.count_if(F.col("method") == "ocr_tesseract").alias("ocr_pages"),
    )


def document_warning(counts: DataFrame, use_ocr: bool) -> DataFrame:
    """book, warning: null where every page has text."""
    after = " page(s) had no extractable text even after OCR fallback and may need manual review."
    off = " page(s) had no extractable text; OCR was disabled for this run and the page(s) may need manual review."
    text = F.concat(F.col("without_text").cast("string"), F.lit(after if use_ocr else off))
    return counts.select("book", F.when(F.col("without_text") > 0, text).alias("warning"))

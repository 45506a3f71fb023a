"""Book files and their sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varaq.config import SETTINGS
from varaq.functions.rules import is_pdf_content, is_pdf_path

SIDECAR = "book_title string, course string, grade string"


def stem(path):
    """The file's name up to its last dot."""
    return F.regexp_replace(F.regexp_replace(path, r"\A.*/", ""), r"(?<=.)\.[^.]*\z", "")


def sidecar_stem(path):
    """The name that a book's sidecar has: without its last two endings."""
    return F.regexp_replace(stem(path), r"(?<=.)\.[^.]*\z", "")


def book_files(spark: SparkSession, folder: str, max_bytes: int = SETTINGS.max_file_bytes) -> DataFrame:
    """name, path, size, modified, sha256, error of the files in a folder, by name.

    The digest is computed where the file is read; content does not leave the executors. Files that cannot be books
    are rows with an error, not failures; Spark's reader leaves out empty files.
    """
    f = spark.read.format("binaryFile").load(folder)
    too_large = F.col("length") > max_bytes
    wrong = F.when(~is_pdf_path(F.col("path")), "unsupported_type").when(too_large, "too_large").when(~is_pdf_content(F.col("content")), "not_a_pdf")
    name = F.regexp_replace("path", r"\A.*/", "")
    return f.select(name.alias("name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.when(~too_large, F.sha2("content", 256)).alias("sha256"), wrong.alias("error")).orderBy("name")


def discovered(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the PDF files of a folder, sorted; contents are not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return f.select(F.regexp_replace("path", r"\A.*/", "").alias("filename")).orderBy("filename")


def chosen(found: DataFrame, names: list[str] | None) -> DataFrame:
    """All books, or those named; an empty list of names is an error."""
    if names is None:
        return found
    if not names:
        raise ValueError("an empty list of names was given")
    return found.where(F.col("filename").isin(*names))


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """book (name without .meta.json) and its metadata; a broken file gives nulls and its text in _corrupt."""
    f = spark.read.schema(SIDECAR + ", _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", "*.meta.json").json(folder)
    return f.select(F.regexp_replace("_metadata.file_name", r"\.meta\.json\z", "").alias("book"), "book_title", "course", "grade", "_corrupt")


def expired_files(spark: SparkSession, folder: str, hours: int, now) -> DataFrame:
    """path of files older than the retention, for delete_files()."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return f.where(F.unix_seconds("modificationTime") < F.unix_seconds(now) - hours * 3600).select("path")


def delete_files(paths: DataFrame, roots: list[str]) -> int:
    """Delete the files of a relation (path), as far as they lie below one of the roots; how many went. Paths come to the
    driver one batch at a time; folders and what is gone already are passed over."""
    from varaq.functions.rules import within_roots

    spark, n = paths.sparkSession, 0
    plain = F.regexp_replace("path", r"\A[a-z]+:(//[^/]*)?", "")
    for r in paths.where(within_roots(plain, roots)).select("path").distinct().toLocalIterator():
        p = spark._jvm.org.apache.hadoop.fs.Path(r.path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        n += bool(fs.exists(p) and fs.getFileStatus(p).isFile() and fs.delete(p, False))
    return n

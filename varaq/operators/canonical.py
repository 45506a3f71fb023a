"""One concept for what several lessons and books call the same: an extension, as the reference has only the place for it.

Titles become names: letters and spaces made uniform, small letters, words in order without repeats. Vertices of one name are
one concept. Two names are similar if four fifths of their words agree (5 x common >= 4 x all words); concepts that a chain
of similar names connects are one. Only names that share a word of their prefix are compared: with words sorted from
the rarest to the commonest, two similar names always share one among the first |words| - ceil(0.8 |words|) + 1 of either,
so no pair is lost and common words bring none together.

Components are found over different names, by passing on the least name and by jumping to the label's label; each round is
written out. Their ids depend on the names alone: a digest of the least one.

Defined results: a title without a letter or digit is a name of its own kind, the empty one, which is similar to none; equal
edges of several lessons are one with their number; an edge whose ends have become one concept goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varaq.functions.text import clean
from varaq.sources import files

#: Common words per words of both, as a fraction.
COMMON, OF = 4, 5


def words_of(title: Column) -> Column:
    """The words of a name, each once, sorted."""
    parts = F.split(F.lower(clean(title)), r"[^\p{L}\p{N}\p{M}]+")
    return F.array_sort(F.array_distinct(F.filter(parts, lambda w: w != "")))


def name_of(title: Column) -> Column:
    return F.array_join(words_of(title), " ")


def similar_names(names: DataFrame) -> DataFrame:
    """a, b: pairs of different similar names, a < b. names: name, each once."""
    words = names.where("name <> ''").select("name", F.explode(F.split("name", " ")).alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("n"))
    ranked = words.join(often, "word").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("w"))
    size = F.size("w")
    first = size - F.ceil(size * COMMON / OF) + 1
    keys = ranked.select("name", F.split("name", " ").alias("words"), F.explode(F.slice("w", F.lit(1), first.cast("int"))).alias("k")).select("name", "words", "k.word")
    other = keys.select("word", F.col("name").alias("b"), F.col("words").alias("other"))
    n, m, common = F.size("words"), F.size("other"), F.size(F.array_intersect("words", "other"))
    near = (OF * n >= COMMON * m) & (OF * m >= COMMON * n) & (OF * common >= COMMON * (n + m - common))
    return keys.join(other, "word").where(F.col("name") < F.col("b")).where(near).select(F.col("name").alias("a"), "b").distinct()


def components(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """name, least: the least name that is connected to each."""
    spark = names.sparkSession
    folder = files.shared_folder(spark, "concepts")
    pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).write.parquet(f"{folder}/pairs")
    edges = spark.read.parquet(f"{folder}/pairs")
    labels = names.select("name", F.col("name").alias("least"))
    k = 0
    while True:
        heard = edges.join(labels, edges["b"] == labels["name"]).groupBy("a").agg(F.min("least").alias("heard")).withColumnRenamed("a", "name")
        passed = labels.join(heard, "name", "left").select("name", "least", F.least("least", "heard").alias("new"))
        of = passed.select(F.col("name").alias("new"), F.col("new").alias("further"))
        jumped = passed.join(of, "new").select("name", "least", F.least("new", "further").alias("new"))
        jumped.write.parquet(f"{folder}/{k}")
        done = spark.read.parquet(f"{folder}/{k}")
        if k:
            files.delete(spark, f"{folder}/{k - 1}")
        if not done.where("new <> least").limit(1).count():
            return done.select("name", F.col("new").alias("least"))
        labels, k = done.select("name", F.col("new").alias("least")), k + 1


def canonical_names(vertices: DataFrame) -> DataFrame:
    """name, concept: the canonical id of each name of the vertices (title)."""
    names = vertices.select(name_of(F.col("title")).alias("name")).distinct()
    found = components(names, similar_names(names))
    return found.select("name", F.concat(F.lit("concept-"), F.substring(F.sha2("least", 256), 1, 16)).alias("concept"))


def assigned(vertices: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """vertices with the id of their canonical concept. vertices: book, id, title and more."""
    names = canonical_names(vertices) if names is None else names
    return vertices.withColumn("name", name_of(F.col("title"))).join(names, "name").drop("name")


def concepts(owned: DataFrame) -> DataFrame:
    """A row a canonical concept: the title of the vertex with the highest confidence, how many vertices and books, and, if
    there are any, the united sources. owned: as of assigned()."""
    best = F.min_by("title", F.struct(-F.col("confidence"), F.col("title")))
    out = [best.alias("title"), F.max("confidence").alias("confidence"), F.count("*").alias("vertices"), F.count_distinct("book").alias("books")]
    if "source_refs" in owned.columns:
        out.append(F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_refs")))).alias("source_refs"))
    return owned.groupBy("concept").agg(*out)


def edges(relationships: DataFrame, owned: DataFrame) -> DataFrame:
    """source, target, type, n: the relationships between canonical concepts, and how many say so."""
    ends = owned.select("book", "id", "concept").distinct()
    out = relationships.select("book", "source_id", "target_id", "type")
    for end in ("source", "target"):
        out = out.join(ends.select("book", F.col("id").alias(f"{end}_id"), F.col("concept").alias(end)), ["book", f"{end}_id"])
    return out.where("source <> target").groupBy("source", "target", "type").agg(F.count("*").alias("n"))

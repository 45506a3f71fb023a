"""Connected components by alternating large and small stars, as DataFrame joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.llm.common import discard, materialise


#: Parts that a node's edges are dealt to where they meet its least neighbour, so that a hub is not one task's.
SALTS = 8


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges u, v with m of u. least: u, m, a row a node; it is repeated for each part of the node's edges."""
    parts = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(parts, ["u", "part"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(edges, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node that edges lead to) of every node that has an edge.

    edges: u, v (long), in any direction; loops are ignored. A hub's edges are never collected: each step
    is a partial aggregation and a join with one row a node and part of its edges. Each
    round is written to the shared folder, so that a lost executor costs one round at most.
    """
    now = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    seen = _fingerprint(now)
    while True:
        after = materialise(_small_star(_large_star(now)), "edges")
        discard(now)
        now, before, seen = after, seen, _fingerprint(after)
        if seen == before:
            break
    # every node now points at its component's least node
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

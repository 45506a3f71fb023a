"""Mixing sources to target weights by Pfair scheduling (operator 2), in DataFrame and SQL functions only.

Each source's documents are cut into blocks. With n of every `period` slots as its target, a source's i-th block
may start in slot floor((i - 1) * period / n) (its release) and must have run before slot ceil(i * period / n) (its
deadline). In each slot the released block with the earliest deadline runs (of equals: the first source by name),
so that after any t slots a source has run less than one block more or less than t * n / period. The windows repeat
every period, so one period is scheduled and every block finds its slot by arithmetic and an equi-join: the
schedule does not grow with the data.

Target weights are given by source, or else follow from the sizes (POWER). Within a source, documents stand in the order
of a digest of their doc_id, which has nothing to do with their content or place.

Slots up to the horizon, the first slot whose source has run out of blocks, hold the targets exactly; the rest of
the longer sources follows in the same proportions. No document is dropped or repeated.

Defined results: null and empty sources are one source; a null doc_id is placed by a digest of its whole row; repeated
rows are separate documents, next to each other; a source without a weight, or with one that is not above 0, gets the
one slot in a period that every source has; texts are carried along whole; an empty table gives an empty result. Names
that this module adds begin with "_"; a table that has one of them is refused (ValueError), so pack it in a struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.llm.common import materialise, table

#: Documents of a block.
BLOCK = 64
#: Slots of a period at least, and slots of it for each source at least.
PERIOD = 1000
SLOTS_PER_SOURCE = 16
#: Target weight of a source: its documents to this power, so that small sources are lifted.
POWER = 0.5
#: Documents of a part, about: sources are ranked in parts by the first digits of the digest, so that no task ranks all of
#: a large one. The order does not depend on it.
PART_ROWS = 100_000
#: Slots of a period whose plan is broadcast, at most; a larger plan is joined by shuffle.
BROADCAST_SLOTS = 200_000
ADDED = ("_source", "_block", "_place", "_slot", "_release", "_deadline", "_in_mix")


def quotas(counts: DataFrame, power: float = POWER, weights: dict[str, float] | None = None) -> DataFrame:
    """k (0, 1, ... by name), source, n and period: whole slots of a period for each source, by largest remainder,
    one at least. counts: source, rows. As many rows as sources."""
    every = Window.partitionBy()
    w = F.pow(F.col("rows").cast("double"), F.lit(power))
    if weights is not None:
        given = F.create_map(*(F.lit(x) for k, v in weights.items() for x in (k, float(v)))) if weights else F.create_map().cast("map<string,double>")
        w = F.greatest(F.coalesce(F.nanvl(given[F.col("source")], F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    w = counts.select("source", "rows", w.alias("w"))
    w = w.withColumns({"sources": F.count("*").over(every), "all_w": F.sum("w").over(Window.partitionBy().orderBy("source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    w = w.withColumn("period", F.greatest(F.lit(PERIOD), F.lit(SLOTS_PER_SOURCE) * F.col("sources")).cast("int"))
    even = F.lit(1.0) / F.col("sources")  # where no weight is above 0
    w = w.withColumn("share", (F.col("period") - F.col("sources")) * F.when(F.col("all_w") > 0, F.col("w") / F.col("all_w")).otherwise(even))
    w = w.withColumns({"whole": F.floor("share"), "rest": F.col("share") - F.floor("share")})
    w = w.withColumn("left_over", F.col("period") - F.col("sources") - F.sum("whole").over(every))
    w = w.withColumn("turn", F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), "source")))
    return w.select(
        (F.row_number().over(Window.partitionBy().orderBy("source")) - 1).alias("k"),
        "source",
        (1 + F.col("whole") + (F.col("turn") <= F.col("left_over")).cast("int")).cast("int").alias("n"),
        "period",
    )


def schedule(quota: DataFrame) -> DataFrame:
    """source, i (1 to n), slot, release, deadline of one period: earliest deadline first over released blocks."""
    listed = quota.agg(F.first("period").alias("period"), F.array_sort(F.collect_list(F.struct("k", "n", "source"))).alias("q")).where("period is not null")
    run = """
    aggregate(
      sequence(0, period - 1),
      named_struct('turn', transform(q, x -> 1), 'plan', cast(array() as array<int>)),
      (acc, t) -> transform(
        array(array_min(transform(
          filter(
            transform(q, (x, k) -> named_struct('due', ((acc.turn[k] * period + x.n - 1) div x.n), 'k', k, 'free', ((acc.turn[k] - 1) * period) div x.n, 'open', acc.turn[k] <= x.n)),
            x -> x.open and x.free <= t),
          x -> named_struct('due', x.due, 'k', x.k)))),
        best -> named_struct(
          'turn', transform(acc.turn, (i, k) -> if(k = best.k, i + 1, i)),
          'plan', concat(acc.plan, array(best.k))))[0],
      acc -> acc.plan)
    """
    slots = listed.select("q", "period", F.posexplode(F.expr(run)).alias("slot", "k"))
    i = F.row_number().over(Window.partitionBy("k").orderBy("slot"))
    at = slots.select(F.expr("q[k]").alias("x"), "slot", "period", i.alias("i"))
    return at.select(
        F.col("x.source").alias("source"),
        "i",
        "slot",
        F.expr("((i - 1) * period) div x.n").alias("release"),
        F.expr("(i * period + x.n - 1) div x.n").alias("deadline"),
    )


def _source(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def mixed(docs: DataFrame, power: float = POWER, block: int = BLOCK, weights: dict[str, float] | None = None) -> DataFrame:
    """docs with _source, _block (0, 1, ... in its source), _place (in the block), _slot, _release, _deadline and
    _in_mix (before the horizon). The mix is the order by _slot, _place. weights: target weights by source ("": none)."""
    if clash := {c.lower() for c in docs.columns} & {*ADDED, "_digest", "_part", "_rank", "_before", "_at0", "_n", "_round", "_i", "_at"}:
        raise ValueError(f"columns with names that are added: {sorted(clash)}")
    by_id = F.md5(F.col("doc_id").cast("string").cast("binary"))
    by_row = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).cast("binary"))
    named = {"_source": _source(F.col("source")), "_digest": F.coalesce(by_id, by_row)}
    digits = max(1, math.ceil(math.log(max(docs.count(), 1) / PART_ROWS, 16)))
    rows = docs.withColumns(named).withColumn("_part", F.substring("_digest", 1, digits))
    light = rows.select("_source", "_part")
    counts = materialise(light.groupBy("_source", "_part").agg(F.count("*").alias("rows")), "counts")  # read four times
    before = F.sum("rows").over(Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_source", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    totals = counts.groupBy("_source").agg(F.sum("rows").alias("rows")).withColumnRenamed("_source", "source")
    quota = materialise(quotas(totals, power, weights), "quotas")
    plan = materialise(schedule(quota), "schedule")
    # the first slot for which a source has no block left
    blocks = totals.join(quota, "source").select("source", "period", "n", F.ceil(F.col("rows") / block).cast("bigint").alias("blocks"))
    ends = blocks.select("source", "period", F.expr("blocks div n").alias("round"), F.expr("cast(blocks % n as int) + 1").alias("i"))
    every = Window.partitionBy()  # over the slots of one period
    ends = plan.join(ends, ["source", "i"], "left").withColumn("_horizon", F.min(F.col("round") * F.col("period") + F.col("slot")).over(every))
    lookup = ends.drop("period", "round").join(quota.select("source", "period"), "source")
    lookup = lookup.select(F.col("source").alias("_source"), F.col("i").alias("_i"), F.struct("slot", "release", "deadline", "period", "_horizon").alias("_at"))
    sizes = quota.select(F.col("source").alias("_source"), F.col("n").alias("_n"))

    rank = F.row_number().over(Window.partitionBy("_source", "_part").orderBy("_digest"))
    ranked = rows.withColumn("_rank", rank).join(offsets, ["_source", "_part"]).withColumn("_at0", F.col("_before") + F.col("_rank") - 1)
    ranked = ranked.withColumns({"_block": F.expr(f"_at0 div {block}"), "_place": F.expr(f"cast(_at0 % {block} as int)")})
    # a row for each source, and for each slot of one period
    small = F.broadcast if plan.count() <= BROADCAST_SLOTS else lambda x: x
    ranked = ranked.join(small(sizes), "_source").withColumns({"_round": F.expr("_block div _n"), "_i": F.expr("cast(_block % _n as int) + 1")})
    ranked = ranked.join(small(lookup), ["_source", "_i"])
    start = F.col("_round") * F.col("_at.period")
    return ranked.withColumns(
        {"_slot": start + F.col("_at.slot"), "_release": start + F.col("_at.release"), "_deadline": start + F.col("_at.deadline")}
    ).withColumn("_in_mix", F.col("_slot") < F.col("_at._horizon")).drop("_digest", "_part", "_rank", "_before", "_at0", "_n", "_round", "_i", "_at")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixed(docs).select(
        "doc_id", F.col("_source").alias("source"), F.col("_block").alias("block"), F.col("_place").alias("place"), F.col("_slot").alias("slot"),
        F.col("_release").alias("release"), F.col("_deadline").alias("deadline"), F.col("_in_mix").alias("in_mix"),
    )


#: Quotas, schedule and places of the same mix: earliest deadline first, slot by slot.
OP2_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '') AS source FROM documents
), sizes AS (
  SELECT source, count(*) AS n_rows, pow(count(*)::DOUBLE, {POWER}) AS w FROM docs GROUP BY source
), shares AS (
  SELECT source, n_rows, w, greatest({PERIOD}, {SLOTS_PER_SOURCE} * count(*) OVER ())::BIGINT AS period, count(*) OVER () AS sources, sum(w) OVER () AS all_w FROM sizes
), parts AS (
  SELECT *, (period - sources) * (w / all_w) AS share FROM shares
), turns AS (
  SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, source) AS turn, period - sources - sum(floor(share)) OVER () AS left_over FROM parts
), quota AS (
  SELECT row_number() OVER (ORDER BY source) AS k, source, n_rows, period, (1 + floor(share) + (turn <= left_over)::INT)::BIGINT AS n FROM turns
), q AS (
  SELECT list(n ORDER BY k) AS ns, max(period) AS period FROM quota
), run(t, turn, best) AS (
  SELECT 0::BIGINT, list_transform(ns, lambda x: 1::BIGINT), NULL::BIGINT FROM q
  UNION ALL
  SELECT t + 1, list_transform(turn, lambda x, i: x + (i = won)::BIGINT), won FROM (
    SELECT t, turn, list_min(list_transform(list_filter(range(1, len(ns) + 1), lambda i: turn[i] <= ns[i] AND ((turn[i] - 1) * period) // ns[i] <= t),
      lambda i: ((turn[i] * period + ns[i] - 1) // ns[i]) * 1000000 + i)) % 1000000 AS won
    FROM run, q WHERE t < period)
), plan AS (
  SELECT quota.source, run.t - 1 AS slot, quota.n, quota.period, row_number() OVER (PARTITION BY quota.source ORDER BY run.t) AS i FROM run JOIN quota ON quota.k = run.best
), ends AS (
  SELECT min((blocks // q2.n) * q2.period + plan.slot) AS horizon
  FROM (SELECT *, (n_rows + {BLOCK} - 1) // {BLOCK} AS blocks FROM quota) q2 JOIN plan ON plan.source = q2.source AND plan.i = q2.blocks % q2.n + 1
), placed AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR)) - 1 AS pos FROM docs
), blocked AS (
  SELECT doc_id, placed.source, pos // {BLOCK} AS block, pos % {BLOCK} AS place, quota.n, quota.period FROM placed JOIN quota ON quota.source = placed.source
)
SELECT doc_id, b.source, block, place::INT AS place, (block // b.n) * b.period + slot AS slot,
  (block // b.n) * b.period + ((i - 1) * b.period) // b.n AS release, (block // b.n) * b.period + (i * b.period + b.n - 1) // b.n AS deadline,
  (block // b.n) * b.period + slot < horizon AS in_mix
FROM blocked b JOIN plan ON plan.source = b.source AND plan.i = b.block % b.n + 1, ends
"""


def in_mixed_order(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in the order of the mix, over the output's files and within each."""
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = docs.select("doc_id", "source", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))  # no name clashes
    return mixed(packed).repartitionByRange(parts, "_slot", "_place").sortWithinPartitions("_slot", "_place").select("_row.*")

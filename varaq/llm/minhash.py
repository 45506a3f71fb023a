"""MinHash near-duplicates by one-permutation hashing with optimal densification (operator 9).

1. One Python pass turns each whole text into its set of 5-word shingles (64-bit hashes), a digest of that
   set, and a one-permutation signature: the hash range is cut into SLOTS bins, each keeps its least hash, and
   an empty bin takes the value of the first filled bin in a fixed random order of its own.
2. Texts with equal sets form classes; one representative (least doc_id) goes on, so copies cost nothing.
3. Signatures are cut into BANDS bands. Each bucket of a band links its members to one centre: edges form a
   star, as many as the bucket has members, never all pairs. The centre is the member that shares most buckets.
4. Candidate edges are confirmed on the full shingle sets.
5. A star compares only with its centre. Buckets whose members still fall into several components get
   STAR_ROUNDS - 1 more centres. What remains open after that is gathered into groups of texts that buckets
   connect, and each group is compared on full sets in blocks of bounded size; a block gives out no more links
   than join its components. So no link is lost to the stars.

Two texts at the threshold of 0.85 share no band with probability (1 - 0.85**6)**26 < 5e-6.

Defined results: null, empty or blank texts have no shingles, link with nothing and stay; a null doc_id gives a
null component_id and stays; rows that repeat a doc_id and its text get a row each, and stay or go together. Texts are
handled whole, whatever their length; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.llm.common import chunks, discard, in_small_batches, materialise, table, window_hashes, word_hashes
from varaq.llm.components import components

SHINGLE = 5
PERCENT = 85
ROWS = 6
BANDS = 26
SLOTS = ROWS * BANDS
STAR_ROUNDS = 3
#: Members of a block when what the stars leave open is compared.
BLOCK = 384
#: Texts to confirm that may be broadcast as ids to pick their texts; more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_ORDER = np.argsort(np.random.default_rng(20170806).random((SLOTS, SLOTS)), axis=1)


def shingle_set(text: bytes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.lower().split()  # bytes: lower() changes A-Z only
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(SHINGLE, len(words))))


def signature(hashes: np.ndarray) -> np.ndarray:
    """SLOTS least hashes, one for each bin, of a sorted, not empty set."""
    with np.errstate(over="ignore"):
        bins = ((hashes >> np.uint64(32)) * np.uint64(SLOTS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    out = np.zeros(SLOTS, dtype=np.uint64)
    filled = np.zeros(SLOTS, dtype=bool)
    at = bins[first].astype(np.int64)
    out[at] = hashes[first]
    filled[at] = True
    if len(first) < SLOTS:
        empty = np.flatnonzero(~filled)
        order = _ORDER[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest

    for whole in batches:
        for batch in chunks(whole):
            sizes, keys, bands = [], [], []
            for b in pc.fill_null(batch.column("text"), "").cast(pa.large_binary()).to_pylist():
                s = shingle_set(b)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None), bands.append(None)
                    continue
                sig = signature(s)
                keys.append(xxh3_128_digest(s.tobytes()))
                rows = sig.reshape(BANDS, ROWS)
                key = np.arange(BANDS, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(ROWS):
                        key = (key ^ rows[:, j]) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunks(whole):
            sets = [shingle_set(b).view(np.int64) for b in pc.fill_null(batch.column("text"), "").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "hashes"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs u, v whose full sets are similar enough."""
    near = (
        pairs.join(sets.select(F.col("rep").alias("u"), F.col("hashes").alias("hu")), "u")
        .join(sets.select(F.col("rep").alias("v"), F.col("hashes").alias("hv")), "v")
        .withColumn("both", F.size(F.array_intersect("hu", "hv")))
    )
    return near.where(100 * F.col("both") >= PERCENT * (F.size("hu") + F.size("hv") - F.col("both"))).select("u", "v")


def _compare_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join the components of a pair of blocks, found on full sets."""
    sets = [np.asarray(h, dtype=np.int64) for h in rows["hashes"]]
    comp, rep = rows["comp"].to_numpy(), rows["rep"].to_numpy()
    m = len(sets)
    size = np.fromiter(map(len, sets), dtype=np.int64, count=m)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), size)
    place = np.cumsum(often > 1) - 1  # shingles of one text alone are never in both
    shared = (often > 1)[column]
    owner, column = owner[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((m, m), dtype=np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        x, y = np.searchsorted(column, (a, a + 4096))
        has = np.zeros((m, 4096), dtype=np.float32)
        has[owner[x:y], column[x:y] - a] = 1
        both += has @ has.T
    near = 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)
    i, j = np.nonzero(np.triu(near & (comp[:, None] != comp[None, :]), 1))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    links = []
    _, first = np.unique(np.stack([comp[i], comp[j]]), axis=1, return_index=True) if len(i) else (None, [])
    for k in first:
        a, b = find(comp[i[k]]), find(comp[j[k]])
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((max(rep[i[k]], rep[j[k]]), min(rep[i[k]], rep[j[k]])))
    return pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def _similar_size(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _with_components(buckets: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return buckets.withColumn("comp", F.col("rep"))
    return (
        buckets.join(comps.select(F.col("node").alias("rep"), F.col("component").alias("found")), "rep", "left")
        .withColumn("comp", F.coalesce("found", "rep"))
        .drop("found")
    )


def _with_found(links: DataFrame, comps: DataFrame | None) -> DataFrame:
    """links and, in place of all links before, the stars that they have come to: few edges, and few rounds from there."""
    return links if comps is None else links.union(comps.where("node <> component").toDF("u", "v"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    texts = in_small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stats = materialise(
        texts.mapInArrow(_signatures, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"), "signatures"
    )
    # one representative for each set; a hot class only adds to one partial minimum in each task
    classes = (
        stats.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    keyed = classes.select("rep", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    crowded = keyed.groupBy("band", "bucket").agg(F.count("*").alias("members")).where("members > 1")
    rows = materialise(keyed.join(crowded, ["band", "bucket"]), "buckets")
    popular = rows.groupBy("rep").agg(F.sum("members").alias("score"))
    buckets = materialise(rows.join(popular, "rep"), "buckets")
    discard(rows)
    members = materialise(buckets.select(F.col("rep").alias("doc_id")).distinct(), "members")
    few = members.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    chosen = texts.join(F.broadcast(members) if few else members.hint("merge"), "doc_id", "left_semi")
    sets = materialise(chosen.mapInArrow(_sets, "rep bigint, hashes array<bigint>").dropDuplicates(["rep"]), "sets")

    comps, used, open_rows = None, None, buckets
    for _ in range(STAR_ROUNDS):
        rows = _with_components(open_rows, comps)
        if used is not None:
            rows = rows.join(used, ["band", "bucket"]).where(~F.array_contains("tried", F.col("rep"))).drop("tried")
        # buckets with members of several components, and their next centre
        centre = (
            rows.groupBy("band", "bucket")
            .agg(
                F.max_by(F.struct(F.col("rep").alias("centre"), F.col("n_shingles").alias("cn"), F.col("comp").alias("ccomp")), F.struct("score", -F.col("rep"))).alias("c"),
                F.min("comp").alias("least"),
                F.max("comp").alias("most"),
            )
            .where("least <> most")
            .select("band", "bucket", "c.*")
        )
        centre = materialise(centre, "centres")
        if centre.isEmpty():
            open_rows = None
            break
        pairs = (
            rows.join(centre, ["band", "bucket"])
            .where((F.col("comp") != F.col("ccomp")) & _similar_size("n_shingles", "cn"))
            .select(F.greatest("rep", "centre").alias("u"), F.least("rep", "centre").alias("v"))
            .distinct()
        )
        comps = components(_with_found(_confirmed(pairs, sets), comps))
        tried = centre.select("band", "bucket", F.array("centre").alias("now"))
        if used is None:
            used = tried.withColumnRenamed("now", "tried")
        else:
            used = tried.join(used, ["band", "bucket"]).select("band", "bucket", F.concat("tried", "now").alias("tried"))
        used = materialise(used, "used")
        open_rows = buckets.join(centre.select("band", "bucket"), ["band", "bucket"], "left_semi")
    if open_rows is not None:
        rows = _with_components(open_rows, comps).join(used, ["band", "bucket"]).where(~F.array_contains("tried", F.col("rep")))
        several = rows.groupBy("band", "bucket").agg(F.min("rep").alias("hub"), F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
        rows = rows.join(several.select("band", "bucket", "hub"), ["band", "bucket"])
        groups = components(rows.select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct()).withColumnsRenamed({"node": "rep", "component": "group"})
        sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        spread = (
            _with_components(groups, comps)
            .join(sizes, "group")
            .withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .join(sets, "rep")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("group", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "comp", "hashes")
        )
        pairs = spread.groupBy("group", "i", "j").applyInPandas(_compare_block, "u bigint, v bigint")
        comps = components(_with_found(pairs.distinct(), comps))
    discard(sets)
    discard(buckets)
    reps = stats.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    if comps is not None:
        reps = reps.join(comps.select(F.col("node").alias("rep"), F.col("component").alias("found")), "rep", "left")
        reps = reps.select("set_key", F.coalesce("found", "rep").alias("rep"))
    return (
        stats.select("doc_id", "n_shingles", "set_key")
        .join(reps, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op9_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The contract by comparison of all sets that share a shingle.
OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(greatest(1, len(words) - 4))) AS i FROM w WHERE len(words) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i + 1 : i + 5], ' ') AS s FROM starts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT u, v FROM shared JOIN sizes su ON su.doc_id = u JOIN sizes sv ON sv.doc_id = v WHERE 100 * shared.n >= 85 * (su.n + sv.n - shared.n)
), reach(u, v) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), least AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON least.u = d.doc_id
"""


def keep_one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near-duplicates, with the columns of docs."""
    kept = near_duplicates(docs).where("kept").select("doc_id")
    known = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").select(*docs.columns)
    return known.unionByName(docs.where("doc_id is null"))

"""Embedding near-duplicates by a robust-pruned flat graph (operator 1).

1. Vectors that are equal form classes; one of each (least vec_id) goes on, with the class's size as its weight.
2. Cluster centres come from a bounded sample; their number grows with the table, and a shard that is still large is
   clustered again, from a sample of its own. Each vector joins the shards of its OVERLAP nearest centres; the nearest
   is its home. A shard whose sampled links a further split would part (a large group of near copies) is cut into parts
   by hash instead, and its queries visit every part.
3. In each part a flat graph is built: leaves of random bisections propose candidates, and of these a vector keeps the
   ones that no kept one occludes (robust pruning). The lists of all shards are united.
4. Each vector searches once, in its home shard, on the united lists: the shard's vectors and those outside of it that
   its vectors' lists lead to. A greedy beam search starts from the medoids of the leaves and from the vector's own
   place, then expands through all neighbours in range. Matches are verified by cosine in double precision.
5. Each part audits sampled queries against all its vectors and, where a match was missed, compares its vectors in full,
   in blocks. A second audit compares sampled vectors, half of them with links, with the whole table; where it misses
   links, the search is repeated with a larger overlap. linked_and_audited() gives that recall.

Every link is counted in one task for both of its ends, so that the two always agree: the common home, else the home of
which both are members (the lesser, if both homes are). Tasks give out counts and as many links as join their vectors;
single pairs leave a task only where neither home has both, and are made distinct.

Defined results: vectors that are null, empty or zero or hold null or non-finite components link with nothing;
vectors of different lengths do not link; rows that repeat a vec_id share its result (and its least vector decides);
a null vec_id gets no links and a null component, and stays; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varaq.llm.common import discard, materialise, table
from varaq.llm.components import components

COSINE = 0.9
#: Vectors that centres are fitted to, at most (smallest hash of vec_id); vectors a centre stands for; centres of one
#: clustering, at most; sampled vectors of a shard that is clustered again; how often that is done.
SAMPLE, PER_CENTRE, MAX_CENTRES, SPLIT_SAMPLE, SPLITS = 16384, 1500, 4096, 2048, 3
OVERLAP = 3
#: Vectors of a part; of a leaf; bisections into leaves; candidates, edges and slack of the pruning; beam of the search.
PART, LEAF, TREES, CANDIDATES, DEGREE, ALPHA, BEAM = 12_000, 96, 3, 24, 16, 1.2, 8
#: Cosine from which a search expands through a neighbour, and from which a list leads out of its shard.
EXPAND, LEADS = 0.8, 0.75
#: Queries of a part's audit, of the audit over all vectors, and the share of links that this must find.
PART_AUDIT, AUDIT, LEAST_RECALL = 48, 256, 0.999
#: Single precision serves to walk; what comes this close is decided in double.
SLACK = 1e-4
_NONE = np.empty(0, dtype=np.int64)


def unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large and very small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres_of(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from a fixed start."""
    rng = np.random.default_rng(11)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(x[a : a + 2048] @ c.T).argmax(axis=1) for a in range(0, len(x), 2048)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, the nearest first; -1 where there are fewer."""
    out = np.full((len(x), k), -1, dtype=np.int64)
    for a in range(0, len(x), 2048):
        s = -(x[a : a + 2048] @ c.T)
        top = np.argpartition(s, k - 1, axis=1)[:, :k] if k < len(c) else np.broadcast_to(np.arange(len(c)), s.shape)
        order = np.argsort(np.take_along_axis(s, top, axis=1), axis=1, kind="stable")
        out[a : a + 2048, : top.shape[1]] = np.take_along_axis(top, order, axis=1)
    return out


# the graph


def leaves(x: np.ndarray, seed: int) -> list[np.ndarray]:
    """Rows of x in leaves of LEAF at most, by random bisection: similar rows tend to share one."""
    rng = np.random.default_rng(seed)
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        a, b = x[rows[rng.choice(len(rows), size=2, replace=False)]]
        order = rows[np.argsort(x[rows] @ (a - b), kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return out


def candidates(x: np.ndarray) -> np.ndarray:
    """For each row the CANDIDATES nearest of the rows that share a leaf with it, the nearest first, -1 where fewer."""
    n = len(x)
    found = np.full((n, TREES * CANDIDATES), -1, dtype=np.int64)
    score = np.full(found.shape, -3, dtype=np.float32)
    for t in range(TREES):
        for rows in leaves(x, t):
            k = min(CANDIDATES, len(rows) - 1)
            if k <= 0:
                continue
            s = x[rows] @ x[rows].T  # LEAF rows at most
            np.fill_diagonal(s, -3)
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            found[rows, t * CANDIDATES : t * CANDIDATES + k] = rows[top]
            score[rows, t * CANDIDATES : t * CANDIDATES + k] = np.take_along_axis(s, top, axis=1)
    order = np.argsort(found, axis=1, kind="stable")  # a row that several trees propose counts once
    found, score = np.take_along_axis(found, order, axis=1), np.take_along_axis(score, order, axis=1)
    again = found[:, 1:] == found[:, :-1]
    score[:, 1:][again] = -3
    order = np.argsort(-score, axis=1, kind="stable")[:, :CANDIDATES]
    score = np.take_along_axis(score, order, axis=1)
    return np.where(score > -2, np.take_along_axis(found, order, axis=1), -1)


def robust_prune(x: np.ndarray) -> list[np.ndarray]:
    """For each row of unit vectors x its pruned out-neighbours, by squared distance."""
    x = x.astype(np.float32)
    every = candidates(x)
    out: list[np.ndarray] = []
    for a in range(0, len(x), 512):
        near = every[a : a + 512]
        there = near >= 0
        y = x[near]
        dist = 2 - 2 * np.matmul(y, x[a : a + 512, :, None])[:, :, 0]
        between = 2 - 2 * np.matmul(y, y.transpose(0, 2, 1))
        alive, kept = there.copy(), np.zeros(near.shape, dtype=bool)
        rows = np.arange(len(near))
        for _ in range(min(DEGREE, near.shape[1])):
            some = alive.any(axis=1)
            if not some.any():
                break
            p = alive.argmax(axis=1)  # the nearest that is left
            kept[rows[some], p[some]] = True
            alive &= ALPHA * between[rows, p] > dist
            alive[rows, p] = False
            alive[~some] = False
        out += [near[i][kept[i]] for i in rows]
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """Rows of x to start from: of each leaf the one nearest to its mean."""
    return np.unique([rows[int((x[rows] @ x[rows].mean(axis=0)).argmax())] for rows in leaves(x, 0)]) if len(x) else _NONE


def both_ways(lists: list[np.ndarray], n: int) -> np.ndarray:
    """Neighbours of each of n rows when edges are walked in both directions; -1 pads. Rows with many keep theirs and
    the first that point to them."""
    a = np.repeat(np.arange(n), [len(v) for v in lists])
    b = np.concatenate([*lists, _NONE])
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = pairs // max(n, 1), pairs % max(n, 1)
    a, b = a[a != b], b[a != b]
    at = np.arange(len(a)) - np.searchsorted(a, a)  # place in its row
    width = max(1, min(int(at.max(initial=0)) + 1, 4 * DEGREE))
    out = np.full((n, width), -1, dtype=np.int64)
    fits = at < width
    out[a[fits], at[fits]] = b[fits]
    if not fits.all():
        for k in np.unique(a[~fits]):
            mine = np.concatenate([lists[k], np.setdiff1d(b[a == k], lists[k])])[:width]  # each once
            out[k, : len(mine)] = mine
    return out


def search(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of queries, row of x) in range. edges: as of both_ways(); own: the query's own row in x, or -1."""
    n = len(x)
    start = medoids(x)
    x4, q4 = x.astype(np.float32), queries.astype(np.float32)
    out_q, out_x = [_NONE], [_NONE]
    for a in range(0, len(queries), 256):
        q = q4[a : a + 256]
        mine = own[a : a + 256]
        rows = np.arange(len(q))
        seen = np.zeros((len(q), n), dtype=bool)
        reached: list[tuple[np.ndarray, np.ndarray]] = []  # pairs in range of expansion

        def scored(r, v, q=q, seen=seen, reached=reached):
            """Cosine of the pairs, which are new; notes those in range."""
            seen[r, v] = True
            cols = np.unique(v) if len(v) > 4096 else None
            if cols is not None and 8 * len(v) > len(q) * len(cols):  # the queries of a group of near copies see the same rows
                s = (q @ x4[cols].T)[r, np.searchsorted(cols, v)]
            else:
                s = np.einsum("id,id->i", q[r], x4[v])
            near = s >= EXPAND - SLACK
            reached.append((r[near], v[near]))
            return s

        k = min(BEAM, len(start))
        first = nearest(q, x4[start], k)
        beam = np.full((len(q), BEAM + 1), -1, dtype=np.int64)
        score = np.full(beam.shape, -3, dtype=np.float32)
        beam[:, :k] = start[first]
        score[:, :k] = scored(np.repeat(rows, k), beam[:, :k].ravel()).reshape(-1, k)
        here = np.flatnonzero(mine >= 0)
        fresh = here[~seen[here, mine[here]]]
        beam[fresh, BEAM] = mine[fresh]
        score[fresh, BEAM] = scored(fresh, mine[fresh])
        done = beam < 0
        while True:
            pick = np.where(done, -4, score).argmax(axis=1)
            r = np.flatnonzero(~done[rows, pick])
            if not len(r):
                break
            done[r, pick[r]] = True
            nb = edges[beam[r, pick[r]]]
            new = (nb >= 0) & ~seen[r[:, None], nb]
            s = np.full(nb.shape, -3, dtype=np.float32)
            s[new] = scored(np.repeat(r, new.sum(axis=1)), nb[new])
            all_s = np.concatenate([score[r], s], axis=1)
            all_n = np.concatenate([beam[r], nb], axis=1)
            all_d = np.concatenate([done[r], ~new], axis=1)
            top = np.argpartition(-all_s, BEAM, axis=1)[:, : BEAM + 1]
            beam[r], score[r], done[r] = (np.take_along_axis(z, top, axis=1) for z in (all_n, all_s, all_d))
        # range expansion: on through the neighbours of everything in range
        at = 0
        while at < len(reached):
            r, v = (np.concatenate(z) for z in zip(*reached[at:], strict=True))
            at = len(reached)
            for c in range(0, len(r), 50_000):
                nb = edges[v[c : c + 50_000]]
                ra = np.repeat(r[c : c + 50_000], nb.shape[1])
                nb = nb.ravel()
                new = (nb >= 0) & ~seen[ra, nb]
                if new.any():
                    code = np.unique(ra[new] * n + nb[new])
                    scored(code // n, code % n)
        r, v = (np.concatenate(z) for z in zip(*reached, strict=True))
        keep = v != mine[r]
        r, v = r[keep], v[keep]
        hit = verified(queries[a : a + 256], x, r, v)
        out_q.append(r[hit] + a)
        out_x.append(v[hit])
    return np.concatenate(out_q), np.concatenate(out_x)


def verified(q: np.ndarray, x: np.ndarray, r: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of the pairs are links, in double precision."""
    out = np.zeros(len(r), dtype=bool)
    cols = np.unique(v)
    if 8 * len(v) > len(q) * len(cols):
        return (q @ x[cols].T)[r, np.searchsorted(cols, v)] >= COSINE
    for a in range(0, len(r), 50_000):
        out[a : a + 50_000] = np.einsum("id,id->i", q[r[a : a + 50_000]], x[v[a : a + 50_000]]) >= COSINE
    return out


def in_full(x: np.ndarray, queries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What search() gives, by comparing all in blocks."""
    out_q, out_x = [_NONE], [_NONE]
    for a in range(0, len(queries), 256):
        r, v = np.nonzero(queries[a : a + 256] @ x.T >= COSINE)
        keep = v != own[a : a + 256][r]
        out_q.append(r[keep] + a)
        out_x.append(v[keep])
    return np.concatenate(out_q), np.concatenate(out_x)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """root (the least row of each row's component) after links a, b are added."""
    while True:
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return root
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


# tasks


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    x = unit(rows["embedding"].tolist())
    ids = rows["vec_id"].to_numpy()
    out = robust_prune(x)
    near = [o[x[o] @ x[i] >= LEADS] if len(o) else o for i, o in enumerate(out)]
    return pd.DataFrame({"vec_id": ids, "nbrs": [ids[o] for o in out], "leads": [ids[o] for o in near]})


FOUND = "kind int, a bigint, b bigint"
#: Kinds of rows that a search gives: b more links of a; a and b in one component; a link outside of both homes.
COUNT, JOIN, LOOSE = 0, 1, 2


def _search_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    home = int(key[0])
    rows = rows.sort_values(["node", "vec_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
    node, asked = rows["node"].to_numpy(dtype=bool), np.flatnonzero(rows["asked"].to_numpy(dtype=bool))
    n = int(node.sum())
    if not n or not len(asked):
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("kind", "a", "b")})
    every = unit(rows["embedding"].tolist())
    x, q = every[:n], every[asked]
    ids, weight = rows["vec_id"].to_numpy(), rows["weight"].to_numpy()
    place = {v: k for k, v in enumerate(ids[:n].tolist())}
    lists = [np.array([place[v] for v in nbrs if v in place], dtype=np.int64) if nbrs is not None else _NONE for nbrs in rows["nbrs"][:n]]
    own = np.where(asked < n, asked, -1)
    r, v = search(x, both_ways(lists, n), q, own)
    audit = np.unique(np.linspace(0, len(q) - 1, min(PART_AUDIT, len(q))).astype(int))
    truth = (q[audit] @ x.T >= COSINE).sum(axis=1) - (own[audit] >= 0)
    if (truth > np.bincount(r, minlength=len(q))[audit]).any():  # this part's graph does not serve
        r, v = in_full(x, q, own)
    a = asked[r]
    width = max(map(len, rows["shards"]))
    shards = np.full((len(rows), width), -1, dtype=np.int64)
    for k, s in enumerate(rows["shards"]):
        shards[k, : len(s)] = s
    homes, part = shards[:, 0], rows["mine"].to_numpy()
    member = (shards == home).any(axis=1)
    both_home = homes[v] == home
    # both at home: counted where the parts are the same (once, whichever end found it) or in the lesser part
    once = both_home & (part[a] == part[v])
    pair = np.unique(np.minimum(a, v)[once] * len(rows) + np.maximum(a, v)[once])
    later = both_home & (part[a] > part[v])
    mutual = (shards[a] == homes[v][:, None]).any(axis=1)  # the other's home has this one as well
    here = ~both_home & member[v] & (~mutual | (homes[v] > home))
    loose = ~both_home & ~member[v] & ~mutual
    one, two = np.concatenate([pair // len(rows), a[later], a[here]]), np.concatenate([pair % len(rows), v[later], v[here]])
    count = np.zeros(len(rows), dtype=np.int64)
    np.add.at(count, one, weight[two])
    np.add.at(count, two, weight[one])
    least = np.argsort(np.argsort(ids, kind="stable"), kind="stable")  # components by least id
    back = np.argsort(ids, kind="stable")
    root = unite(np.arange(len(rows)), least[a], least[v])
    joined = np.flatnonzero(root != np.arange(len(rows)))
    some = np.flatnonzero(count)
    x1, x2 = ids[a[loose]], ids[v[loose]]
    out = [(COUNT, ids[some], count[some]), (JOIN, ids[back[joined]], ids[back[root[joined]]]), (LOOSE, np.minimum(x1, x2), np.maximum(x1, x2))]
    return pd.concat([pd.DataFrame({"kind": k, "a": u, "b": w}) for k, u, w in out], ignore_index=True).astype("int64")


def _assigner(shared, overlap: int):
    def run(batches):
        centres = shared.value
        for pdf in batches:
            if pdf.empty:
                continue
            shards: list = [None] * len(pdf)
            for d, rows in pdf.groupby(pdf["embedding"].map(len).to_numpy()).indices.items():
                offset, c = centres.get(d, (0, None))
                if c is None:  # a length that the sample has not: a shard of its own
                    for k in rows:
                        shards[k] = [-d - 2]
                    continue
                top = nearest(unit(pdf["embedding"].iloc[rows].tolist()), c, overlap)
                for k, t in zip(rows, top, strict=True):
                    shards[k] = (t[t >= 0] + offset).tolist()
            yield pdf.assign(shards=shards)

    return run


def _recluster(overlap: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Centres of a shard's sample, unless its links would be parted by them."""
        x = unit(rows["embedding"].tolist())
        k = int(max(2, min(MAX_CENTRES, len(x) // 4, rows["n"].iloc[0] // PER_CENTRE)))
        c = centres_of(x, k)
        top = nearest(x, c, overlap)
        i, j = np.nonzero(np.triu(x @ x.T >= COSINE, 1))  # SPLIT_SAMPLE rows, about
        kept = (top[i] == top[j][:, :1]).any(axis=1) | (top[j] == top[i][:, :1]).any(axis=1)
        if len(i) and kept.mean() < LEAST_RECALL or np.bincount(top[:, 0]).max() > 0.9 * len(x):
            return pd.DataFrame({"shard": pd.Series(dtype="int64"), "centres": pd.Series(dtype="object")})
        return pd.DataFrame({"shard": rows["shard"].iloc[:1].to_numpy(), "centres": [[v.tolist() for v in c]]})

    return run


def _resharded(overlap: int):
    def run(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """The new shards of each row in place of its old one. Shards that get one number by chance are searched as one."""
        if rows.empty or found.empty:
            return pd.DataFrame({"vec_id": pd.Series(dtype="int64"), "pos": pd.Series(dtype="int64"), "more": pd.Series(dtype="object")})
        c = np.array([np.asarray(v) for v in found["centres"].iloc[0]])
        base = (int(rows["shard"].iloc[0]) * 0x9E3779B97F4A7C15 + 0x2545F491) % (1 << 61)
        top = nearest(unit(rows["embedding"].tolist()), c, overlap)
        top[rows["pos"].to_numpy() > 0, 1:] = -1  # all of the overlap at home, one elsewhere: lists grow by steps, not in powers
        more = [[(base + int(t)) % (1 << 61) + (1 << 40) for t in ts if t >= 0] for ts in top]
        return pd.DataFrame({"vec_id": rows["vec_id"].to_numpy(), "pos": rows["pos"].to_numpy(), "more": more})

    return run


def _split(assigned: DataFrame, overlap: int) -> DataFrame:
    """assigned (vec_id, embedding, weight, shards: home first) with large shards clustered again."""
    for _ in range(SPLITS):
        members = assigned.select("vec_id", "embedding", F.posexplode("shards").alias("pos", "shard"))
        large = members.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > PART)
        large = materialise(large, "large")
        if large.isEmpty():
            return assigned
        members = members.join(large, "shard").withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.ceil(F.col("n") / PART)).cast("int"))
        some = members.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.greatest(F.lit(1), F.expr(f"n div {SPLIT_SAMPLE}"))) == 0)
        found = materialise(some.select("shard", "embedding", "n").groupBy("shard").applyInPandas(_recluster(overlap), "shard bigint, centres array<array<double>>"), "centres")
        if found.isEmpty():
            return assigned
        to_all = found.join(large, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / PART).cast("int") - 1)).alias("chunk"), "centres")
        moved = members.join(found.select("shard"), "shard", "left_semi").groupBy("shard", "chunk").cogroup(to_all.groupBy("shard", "chunk"))
        moved = moved.applyInPandas(_resharded(overlap), "vec_id bigint, pos bigint, more array<bigint>")
        by_vector = moved.groupBy("vec_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "more"))).alias("moved"))
        lists = F.expr("array_distinct(flatten(transform(shards, (s, i) -> coalesce(moved[i], array(s)))))")
        assigned = materialise(assigned.join(by_vector, "vec_id", "left").withColumn("shards", lists).drop("moved"), "assigned")
    return assigned


def _usable(v) -> F.Column:
    x = F.transform(v, lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)) & F.exists(x, lambda e: e != 0.0)


@dataclass(frozen=True)
class Audit:
    """Links of the sampled vectors by comparison with all, and how many of them the graph gave."""

    links: int
    found: int
    overlap: int

    @property
    def recall(self) -> float | None:
        return self.found / self.links if self.links else None


def _audited(counts: DataFrame, reps: DataFrame, overlap: int) -> Audit:
    """Of AUDIT vectors, as far as there are so many, half are such that the graph has found links of."""
    spark = reps.sparkSession
    order = (F.xxhash64("vec_id"), "vec_id")
    having = reps.join(counts.where("n > 0").select("vec_id"), "vec_id", "left_semi").orderBy(*order).limit(AUDIT // 2)
    asked = having.unionByName(reps.orderBy(*order).limit(AUDIT // 2)).select("vec_id", "embedding").toPandas().drop_duplicates("vec_id")
    if asked.empty:
        return Audit(0, 0, overlap)
    by = {d: (g["vec_id"].to_numpy(), unit(g["embedding"].tolist())) for d, g in asked.groupby(asked["embedding"].map(len))}
    shared = spark.sparkContext.broadcast(by)  # AUDIT vectors

    def run(batches):
        for pdf in batches:
            for d, g in pdf.groupby(pdf["embedding"].map(len)) if not pdf.empty else ():
                if d not in shared.value:
                    continue
                qids, q = shared.value[d]
                ids, w = g["vec_id"].to_numpy(), g["weight"].to_numpy()
                near = (q @ unit(g["embedding"].tolist()).T >= COSINE) & (qids[:, None] != ids[None, :])
                n = near @ w
                yield pd.DataFrame({"vec_id": qids[n > 0], "truth": n[n > 0]})

    truth = reps.select("vec_id", "embedding", "weight").mapInPandas(run, "vec_id bigint, truth bigint").groupBy("vec_id").agg(F.sum("truth").alias("truth"))
    got = truth.join(counts, "vec_id", "left").agg(F.sum("truth").alias("t"), F.sum(F.least("truth", F.coalesce("n", F.lit(0)))).alias("n")).first()
    return Audit(got["t"] or 0, got["n"] or 0, overlap)


def _searched(reps: DataFrame, assigned: DataFrame) -> DataFrame:
    """The rows that the searches of all parts give (FOUND)."""
    light = assigned.select("vec_id", "shards", F.explode("shards").alias("shard"))
    sizes = light.groupBy("shard").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    sizes = materialise(sizes, "sizes")
    mine = lambda c: F.pmod(F.xxhash64(c), F.col("parts")).cast("int")
    members = assigned.select("*", F.explode("shards").alias("shard")).join(sizes, "shard").withColumn("mine", mine("vec_id"))
    built = members.select("shard", "mine", "vec_id", "embedding").groupBy("shard", "mine").applyInPandas(_build, "vec_id bigint, nbrs array<bigint>, leads array<bigint>")
    flat = lambda c: F.array_distinct(F.flatten(F.collect_list(c))).alias(c)
    union = materialise(built.groupBy("vec_id").agg(flat("nbrs"), flat("leads")), "graph")  # a list for each of its shards
    vectors = assigned.join(union, "vec_id")
    leads = light.join(union.select("vec_id", "leads"), "vec_id").select("shard", "shards", F.explode("leads").alias("vec_id"))
    # outside: vectors that lists of a shard's vectors lead to; a vector's own shards are no news to it
    outside = leads.select("shard", "vec_id").distinct().join(vectors, "vec_id").where(~F.array_contains("shards", F.col("shard")))
    common = ("shard", "part", "vec_id", "embedding", "weight", "shards", "mine")
    at_home = F.col("shard") == F.col("shards")[0]
    nodes = vectors.select("*", F.explode("shards").alias("shard")).join(sizes, "shard").withColumn("mine", mine("vec_id")).withColumn("part", F.col("mine"))
    nodes = nodes.select(*common, "nbrs", F.lit(True).alias("node"), at_home.alias("asked"))
    halo = outside.join(sizes, "shard").withColumn("mine", mine("vec_id")).withColumn("part", F.col("mine"))
    halo = halo.select(*common, "nbrs", F.lit(True).alias("node"), F.lit(False).alias("asked"))
    visits = members.where(at_home & (F.col("parts") > 1)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("part <> mine")
    visits = visits.select(*common, F.lit(None).cast("array<bigint>").alias("nbrs"), F.lit(False).alias("node"), F.lit(True).alias("asked"))
    rows = nodes.unionByName(halo).unionByName(visits)
    found = materialise(rows.groupBy("shard", "part").applyInPandas(_search_part, FOUND), "links")
    discard(union)
    return found


def linked_and_audited(vectors: DataFrame) -> tuple[DataFrame, Audit]:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding), and the audit of the links."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    one = good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    reps = materialise(one.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight")), "vectors")
    sample = reps.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()
    total = reps.count()
    overlap = OVERLAP
    while True:
        centres, offset = {}, 0
        for d, g in sample.groupby(sample["embedding"].map(len)) if total else ():
            x = unit(g["embedding"].tolist())
            k = max(1, min(MAX_CENTRES, len(x) // 4, round(total * len(x) / len(sample) / PER_CENTRE)))
            centres[d] = (offset, centres_of(x, k))
            offset += k
        shared = spark.sparkContext.broadcast(centres)  # MAX_CENTRES vectors of each length of the sample
        schema = T.StructType([*reps.schema.fields, T.StructField("shards", T.ArrayType(T.LongType()))])
        assigned = materialise(reps.mapInPandas(_assigner(shared, overlap), schema), "assigned")
        got = _searched(reps, _split(assigned, overlap))
        loose = got.where(f"kind = {LOOSE}").select("a", "b").distinct()
        weights = reps.select("vec_id", "weight")
        both = loose.union(loose.select("b", "a")).toDF("vec_id", "other").join(weights.toDF("other", "n"), "other").select("vec_id", "n")
        counts = materialise(got.where(f"kind = {COUNT}").select("a", "b").toDF("vec_id", "n").union(both).groupBy("vec_id").agg(F.sum("n").alias("n")), "counts")
        audit = _audited(counts, reps, overlap)
        if audit.recall is None or audit.recall >= LEAST_RECALL or overlap >= max(len(c) for _, c in centres.values()):
            break
        discard(got)
        overlap *= 2
    comps = components(got.where(f"kind <> {COUNT}").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    by_class = (
        reps.join(counts, "vec_id", "left")
        .join(comps.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    found = one.join(by_class, "embedding").select("vec_id", "n_links", "component_id")
    out = (
        rows.select("vec_id")
        .join(found, "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
    return out, audit


def linked(vectors: DataFrame) -> DataFrame:
    return linked_and_audited(vectors)[0]


def op1_graph_dedup(spark, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))


#: The contract by comparison of all pairs.
OP1_SQL = """
WITH RECURSIVE raw AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), good AS (
  SELECT vec_id, list_transform(v, lambda e: e / list_max(list_transform(v, lambda x: abs(x)))) AS v FROM raw
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(v, lambda e: e <> 0)) > 0
), normed AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM good
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM normed a JOIN normed b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
), reach(u, v) AS (
  SELECT vec_id, vec_id FROM raw UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), least AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
), n AS (
  SELECT u, count(*) AS n_links FROM links GROUP BY u
)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.u LEFT JOIN least ON e.vec_id = least.u
"""

"""Source divergence audit (operator 12): how far the vocabularies of the sources of a language lie apart, and the terms
that a source uses more than its language does.

Each task counts the terms of its texts by language and source and sends what it has counted, so that a hot source is
added up before the shuffle. All arithmetic is on integers: p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

Pairs are sparse. A term that neither source has differs by the baselines p0 (count 0) alone, so

    sum |p_s - p_t| = V |p0_s - p0_t|                                                     (every term at its baseline)
        + sum over terms of s (|p_s - p0_t| - |p0_s - p0_t|), and the same for t          (one side known)
        + sum over terms of both (|p_s - p_t| - |p_s - p0_t| - |p_t - p0_s| + |p0_s - p0_t|)   (both sides known)

The second line comes from how often each p occurs in a source, the third is added up in the tasks that hold the terms:
what leaves a task is one sum for each pair of sources, never the pairs of a term.

The k largest of a group are found by radix selection: histograms over the digits of the value, from the highest digit on,
find the kth value; its ties are cut by histograms over the bytes of the item, past what they have in common, until those
at the boundary are at most TIES. No group is ever sorted whole.

Defined results: null text, lang and source count as ''; every row of documents counts, repeated ones and those without
a doc_id too; a group without kept terms has pairs of value 0 (V = 0) or at its baseline; further columns are not read; an
empty table gives no rows. Very long texts are cut at word limits into pieces that are counted one after the other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.llm.common import chunks, in_small_batches, materialise, table

LEAST_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
SMOOTH = 5
#: Bits of a digit of the radix selection; a group's histogram has at most 2^BITS rows.
BITS = 11
#: Rows that may be tied at a group's boundary when they are ranked together.
TIES = 256
#: Groups (language and source) up to which their totals are broadcast: 40 bytes each.
BROADCAST_GROUPS = 20_000
#: Counters that a task holds before it sends them; rows of kept terms that are compared at once.
HELD, AT_ONCE = 200_000, 200_000
PIECE = 4_000_000

#: Bytes: small letters for capitals, a space for every other ASCII character but small letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _words(text: str) -> Iterator[list[bytes]]:
    raw = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= PIECE else raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split(b" ") if at or end < len(raw) else raw.split(b" ")
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it): partial sums. docs: lang, source, text, no nulls."""

    def sent(n: dict, d: dict) -> pa.RecordBatch:
        rows = [(g[0], g[1], w.decode("utf-8", "replace"), c, d[g][w]) for g, counts in n.items() for w, c in counts.items() if w]
        cols = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, d = {}, {}
        for batch in batches:
            for part in chunks(batch):
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    one = Counter()
                    for words in _words(text):
                        one.update(words)
                    n.setdefault((lang, source), Counter()).update(one)
                    d.setdefault((lang, source), Counter()).update(one.keys())
                if sum(map(len, n.values())) > HELD:
                    yield sent(n, d)
                    n, d = {}, {}
        yield sent(n, d)

    return in_small_batches(docs).select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, n_lang of the terms that stand in enough documents of their language."""
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")  # a row for each source
    counts = counts.withColumns({"n_lang": F.sum("n").over(w), "in_docs": F.sum("docs").over(w)})
    return counts.where(F.col("in_docs") >= least).drop("docs", "in_docs")


def share(n: Column, total: Column, terms: Column) -> Column:
    """p, exact: the product needs more than a long. Null where the language keeps no term."""
    of = (total + SMOOTH * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", (n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), of))


def totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n_all, lang_all, n_terms (V), p0: one row for each group."""
    of_lang = kept.groupBy("lang", "term").agg(F.max("n_lang").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_all"), F.count("*").alias("n_terms"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    t = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["n_all", "lang_all", "n_terms"])
    return t.withColumn("p0", F.coalesce(share(F.lit(0).cast("bigint"), F.col("n_all"), F.col("n_terms")), F.lit(0)))


def _both_sided(rows: DataFrame) -> DataFrame:
    """lang, source, item, value: partial sums over terms of both sources, source < item. rows: lang, term, source, p, p0."""

    def sums(pdf) -> Iterator[pa.RecordBatch]:
        for lang, part in pdf.groupby("lang", sort=False):
            who, at = np.unique(part["source"].to_numpy(), return_inverse=True)
            terms, col = np.unique(part["term"].to_numpy(), return_inverse=True)
            p, has, p0 = np.zeros((len(who), len(terms)), np.int64), np.zeros((len(who), len(terms)), bool), np.zeros(len(who), np.int64)
            p[at, col], has[at, col], p0[at] = part["p"], True, part["p0"]
            for i in range(len(who) - 1):
                mine = np.flatnonzero(has[i])
                other, there = p[i + 1 :, mine], has[i + 1 :, mine]
                base = p0[i + 1 :, None]
                x = np.abs(p[i, mine] - other) - np.abs(p[i, mine] - base) - np.abs(other - p0[i]) + np.abs(base - p0[i])
                x = np.where(there, x, 0).sum(axis=1)
                at_all = np.flatnonzero(there.any(axis=1))
                yield pa.record_batch([pa.array([lang] * len(at_all), pa.string()), pa.array([who[i]] * len(at_all), pa.string()), pa.array(who[i + 1 :][at_all], pa.string()), pa.array(x[at_all])], ["lang", "source", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n > AT_ONCE:  # cut before the last term, whose other sources may still come
                pdf = pa.Table.from_batches(held).to_pandas()
                open_ = (pdf["lang"] == pdf["lang"].iloc[-1]) & (pdf["term"] == pdf["term"].iloc[-1])
                if not open_.all():
                    yield from sums(pdf[~open_])
                    held = pa.Table.from_pandas(pdf[open_], schema=batch.schema, preserve_index=False).to_batches()
                    n = int(open_.sum())
        if n:
            yield from sums(pa.Table.from_batches(held).to_pandas())

    dealt = rows.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(run, "lang string, source string, item string, value bigint")


def divergences(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language), value: the sum of |p - q| over all kept terms.
    rows: lang, term, source, p, p0 of the terms that a source has; groups: as of totals()."""
    pair = ["lang", "source", "item"]
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    gap = F.abs(F.col("p0") - F.col("q0"))
    base = groups.join(other, "lang").where("source < item").select(*pair, (gap * F.col("n_terms")).alias("value"))
    often = rows.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))
    one = often.join(other, "lang").where("source <> item").select(
        "lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"), (F.col("m") * (F.abs(F.col("p") - F.col("q0")) - gap)).alias("value")
    )
    summed = base.unionByName(one).unionByName(_both_sided(rows)).groupBy(*pair).agg(F.sum("value").alias("value"))
    either = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return summed.select("lang", F.explode(either).alias("e"), "value").select("lang", "e.*", "value")


def _first_reaching(hist: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of each group's histogram (digit, m, need): the digit that holds the need-th row, and what is still needed there.
    A group that has no more rows than it needs takes its last digit whole."""
    w = Window.partitionBy(*keys)
    run = w.orderBy(order)
    cum = hist.withColumns({"cum": F.sum("m").over(run.rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("m").over(w)})
    cum = cum.withColumn("need", F.least("need", "all"))
    return cum.where((F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("m") < F.col("need"))).withColumn("need", F.col("need") - F.col("cum") + F.col("m")).drop("cum", "all")


def kth_values(df: DataFrame, keys: list[str], k: int, largest: int, sent=lambda state: state) -> DataFrame:
    """keys, bound (the kth largest value, or the least of a group with fewer), need (rows wanted at the bound), m (rows
    at it). Values lie between 0 and `largest`; `sent` may broadcast the groups' state, a row for each of them."""
    passes = max(1, -(-int(largest).bit_length() // BITS))
    state = None
    for shift in range((passes - 1) * BITS, -1, -BITS):
        rows = df.withColumn("head", F.shiftright("value", shift + BITS) if shift + BITS < 64 else F.lit(0).cast("bigint"))
        digit = F.shiftright("value", shift).bitwiseAND((1 << BITS) - 1)
        if state is None:
            hist = rows.groupBy(*keys, "head", digit.alias("digit")).agg(F.count("*").alias("m")).withColumn("need", F.lit(k).cast("bigint"))
        else:
            hist = rows.join(sent(state), [*keys, "head"]).groupBy(*keys, "head", digit.alias("digit"), "need").agg(F.count("*").alias("m"))
        found = _first_reaching(hist, keys, F.desc("digit"))
        state = found.select(*keys, F.shiftleft("head", BITS).bitwiseOR(F.col("digit")).alias("head"), "need", "m")
        if shift:
            state = state.drop("m")
    return state.withColumnRenamed("head", "bound")


def radix_top(df: DataFrame, keys: list[str], k: int = TOP, ties: int = TIES, few: bool = False) -> DataFrame:
    """The k rows of each group with the largest value (a long, not negative), ties by the bytes of item; with rank.
    few: there are so few groups that a row of each can be broadcast."""
    sent = F.broadcast if few else lambda state: state
    largest = df.agg(F.max("value")).first()[0] or 0
    bound = materialise(kth_values(df, keys, k, largest, sent), "bounds")
    df = df.withColumn("_bytes", F.hex("item"))
    at = lambda: df.join(sent(state), keys).where((F.col("value") == F.col("bound")) & F.col("_bytes").startswith(F.col("prefix")))
    state = bound.withColumn("prefix", F.lit(""))
    while state.where((F.col("m") > F.col("need")) & (F.col("m") > ties)).limit(1).count():
        wide = (F.col("m") > F.col("need")) & (F.col("m") > ties)
        tied = materialise(at().where(wide).select(*keys, "bound", "prefix", "need", "_bytes"), "ties")
        # what the first and the last tied item have in common, all have
        ends = tied.groupBy(*keys).agg(F.min("_bytes").alias("lo"), F.max("_bytes").alias("hi"))
        most = "cast(least(length(lo), length(hi)) div 2 as int)"
        same = F.expr(f"""aggregate(sequence(1, {most} + 1), 0,
            (n, i) -> if(n = i - 1 and i <= {most} and substring(lo, 2 * i - 1, 2) = substring(hi, 2 * i - 1, 2), i, n))""")
        ends = ends.select(*keys, (2 * same).alias("common"))
        hist = tied.join(sent(ends), keys).groupBy(*keys, "bound", "need", "common", F.expr("substring(_bytes, 1, common + 2)").alias("digit")).agg(F.count("*").alias("m"))
        found = _first_reaching(hist, keys, F.asc("digit")).select(*keys, "bound", "need", "m", F.col("digit").alias("prefix"))
        state = materialise(found.unionByName(state.where(~wide).select(*found.columns)), "bounds")
    near = df.join(sent(state), keys)
    sure = (F.col("value") > F.col("bound")) | ((F.col("value") == F.col("bound")) & (F.col("_bytes") < F.col("prefix")))
    taken = near.where(sure | ((F.col("value") == F.col("bound")) & F.col("_bytes").startswith(F.col("prefix"))))  # < k + ties rows a group
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("value"), F.asc("_bytes")))
    return taken.withColumn("rank", rank).where(F.col("rank") <= k).select(*keys, "item", "value", "rank")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. docs: lang, source, text."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = docs.select("lang", "source").distinct()
    kept = materialise(kept_terms(docs, least), "kept")
    groups = materialise(totals(groups, kept), "groups")
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    rows = kept.join(F.broadcast(groups) if few else groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("n_all"), F.col("n_terms")), share(F.col("n_lang"), F.col("lang_all"), F.col("n_terms"))
    rows = materialise(rows.select("lang", "source", "term", "p0", p.alias("p"), q.alias("q")), "shares")
    more = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = radix_top(more, ["lang", "source"], top, few=few).withColumn("part", F.lit("term"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    pairs = divergences(rows, groups).withColumns({"rank": ranked, "part": F.lit("pair")})
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    ), w AS (
      SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ), kept AS (
      SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}
    ), n AS (
      SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
    ), g AS (SELECT DISTINCT lang, source FROM d), every AS (
      SELECT g.lang, g.source, kept.term, coalesce(n.c, 0)::HUGEINT AS c, kept.c::HUGEINT AS cl
      FROM g JOIN kept USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term
    ), s AS (
      SELECT lang, source, term, c, 1 + {SCALE} * (c + {SMOOTH}) // (sum(c) OVER g + {SMOOTH} * count(*) OVER g) AS p,
        1 + {SCALE} * (cl + {SMOOTH}) // (sum(cl) OVER g + {SMOOTH} * count(*) OVER g) AS q
      FROM every WINDOW g AS (PARTITION BY lang, source)
    ), pair AS (
      SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT u.lang, u.source, v.source AS item, sum(abs(u.p - v.p)) AS value FROM s u JOIN s v ON u.lang = v.lang AND u.term = v.term GROUP BY ALL) x
        ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    ), found AS (
      SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pair
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM s WHERE c > 0 AND p > q
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
    )
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""

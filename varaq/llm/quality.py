"""Quality rules: a decision list learned by sequential covering (operator 8).

Statistics of each whole text are computed in one pass; rules are grown and pruned on a bounded sample of
labelled rows (IREP-style: grow by FOIL gain, prune on held-back rows, stop when a rule no longer pays) and
come out as an ordered list of threshold conjunctions, which are applied as Spark conditional expressions.

Defined results: a null or empty text has no words and fails the base rule; without usable labels the list
is empty and only the base rule decides; repeated labels of a document count once, as the lowest quality, and rows
that repeat a doc_id are learned from once, by their least statistics;
labels that are null or not 0/1 are left out; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varaq.llm.common import chunks, in_small_batches, window_hashes, word_hashes

#: Labelled rows that the rules are learned from, at most (those with the smallest hash of doc_id).
MAX_LABELLED = 12_000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_adjacent")
STATS_SCHEMA = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in STATS)

#: Ratios that rules may test: numerator, denominator.
FEATURES = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "adjacent_share": ("n_adjacent", "n_words"),  # a word right after itself; unlike the share of distinct words it does not fall with length
}

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_MARKS = b"!?"


def _batch_stats(texts: list[bytes], chars: np.ndarray) -> dict[str, np.ndarray]:
    n = len(texts)
    out = {c: np.zeros(n, dtype=np.int64) for c in STATS}
    words_of: list[list[bytes]] = []
    for i, b in enumerate(texts):
        words = b.split()
        words_of.append(words)
        solid = b"".join(words)
        out["n_words"][i] = len(words)
        out["word_chars"][i] = chars[i] - (len(b) - len(solid))
        out["n_symbols"][i] = len(solid) - len(solid.translate(None, _SYMBOLS))
        out["n_upper"][i] = len(solid) - len(solid.translate(None, _UPPER))
        out["n_marks"][i] = len(solid) - len(solid.translate(None, _MARKS))
        lines = [x for x in b.split(b"\n") if x and not x.isspace()]
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    # windows of all texts at once; a window's key also holds its text, so texts never mix
    counts = out["n_words"]
    flat = word_hashes([w for words in words_of for w in words])
    if len(flat) > 1:
        doc_of = np.repeat(np.arange(n), counts)
        again = (flat[1:] == flat[:-1]) & (doc_of[1:] == doc_of[:-1])
        out["n_adjacent"] = np.bincount(doc_of[1:][again], minlength=n).astype(np.int64)
    keys = window_hashes(flat, WINDOW)
    if len(keys):
        doc = doc_of
        ends = np.cumsum(counts)
        inside = np.arange(len(keys)) + WINDOW <= ends[doc[: len(keys)]]
        at = np.flatnonzero(inside)
        owner = doc[at]
        keyed = keys[at]
        order = np.lexsort((keyed, owner))
        k, d = keyed[order], owner[order]
        same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
        twice = np.zeros(len(k), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        starts = at[order[twice]]
        edge = np.zeros(len(flat) + 1, dtype=np.int32)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + WINDOW, -1)
        covered = np.cumsum(edge[:-1]) > 0
        out["n_repeat_words"] = np.bincount(doc[covered], minlength=n).astype(np.int64)
    return out


def _stats(first: str, within: str | None = None):
    """Statistics beside the column `first`. The text is the column text, or the field `within` of the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if within is not None:
                row = whole.column(first)
                whole = pa.RecordBatch.from_arrays([row, pc.struct_field(row, within).cast(pa.string())], names=[first, "text"])
            for batch in chunks(whole):
                text = pc.fill_null(batch.column("text"), "")
                got = _batch_stats(text.cast(pa.large_binary()).to_pylist(), pc.utf8_length(text).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([batch.column(first), *(pa.array(got[c]) for c in STATS)], names=[first, *STATS])

    return run


def with_text_stats(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns of docs, whatever their names) and the statistics of its text, in one pass."""
    packed = in_small_batches(docs).select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    schema = T.StructType([packed.schema["row"], *(T.StructField(c, T.LongType()) for c in STATS)])
    return packed.mapInArrow(_stats("row", "text"), schema)


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text; one row per input row."""
    return in_small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_stats("doc_id"), STATS_SCHEMA)


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({k: _ratio(F.col(a), F.col(b)) for k, (a, b) in FEATURES.items()})


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    value: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.value if self.at_least else x[self.feature] <= self.value

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.value) if self.at_least else c <= F.lit(self.value)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """FOIL's gain of keeping p positives and n negatives of p0 and n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _grow(x: dict[str, np.ndarray], y: np.ndarray, max_conditions: int) -> Rule:
    rule: list[Condition] = []
    live = np.ones(len(y), dtype=bool)
    while len(rule) < max_conditions:
        p0, n0 = float(y[live].sum()), float((~y[live]).sum())
        if p0 == 0 or n0 == 0:
            break
        best, found = 1e-9, None
        for name in FEATURES:
            v, t = x[name][live], y[live]
            order = np.argsort(v, kind="stable")
            v, t = v[order], t[order]
            cut = np.flatnonzero(v[1:] > v[:-1])  # between cut and cut + 1
            if not len(cut):
                continue
            cp = np.cumsum(t)[cut].astype(float)
            cn = (cut + 1) - cp
            middle = (v[cut] + v[cut + 1]) / 2
            for at_least, g in ((False, _gain(cp, cn, p0, n0)), (True, _gain(p0 - cp, n0 - cn, p0, n0))):
                k = int(np.argmax(g))
                if g[k] > best:
                    best, found = float(g[k]), Condition(name, at_least, float(middle[k]))
        if found is None:
            break
        rule.append(found)
        live &= found.holds(x)
    return tuple(rule)


def _worth(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> float:
    c = _covers(rule, x, len(y))
    p, n = int(y[c].sum()), int((~y[c]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(
    x: dict[str, np.ndarray], rejected: np.ndarray, max_rules: int = 12, max_conditions: int = 3, precision: float = 0.95, min_cover: int = 8
) -> list[Rule]:
    """Rules for rows to reject, in order. A rule stays if, on all rows that it reaches, at least `precision`
    of what it covers is labelled as rejected and it covers min_cover of those."""
    rules: list[Rule] = []
    n = len(rejected)
    left = np.ones(n, dtype=bool)
    held_back = np.arange(n) % 3 == 2
    while len(rules) < max_rules and rejected[left].sum() >= min_cover:
        g, h = left & ~held_back, left & held_back
        rule = _grow({k: v[g] for k, v in x.items()}, rejected[g], max_conditions)
        if not rule:
            break
        xh, yh = {k: v[h] for k, v in x.items()}, rejected[h]
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: _worth(r, xh, yh))  # longest of equals
        covered = _covers(rule, x, n) & left
        p = int(rejected[covered].sum())
        if p < min_cover or p < precision * covered.sum():
            break
        rules.append(rule)
        left &= ~covered
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, limit: int) -> DataFrame:
    """doc_id, y of at most `limit` labelled documents: those with the smallest hash of doc_id.

    Its size is bounded by `limit`, so it may be broadcast.
    """
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    sample = labelled_sample(docs, labels, "quality", max_labelled)
    some = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id"
    )
    # rows that repeat a labelled doc_id count once (the least statistics), so at most max_labelled come to the driver
    once = text_stats(some).groupBy("doc_id").agg(F.min(F.struct(*STATS)).alias("s")).select("doc_id", "s.*")
    rows = with_features(once).join(F.broadcast(sample), "doc_id").where(~base_failed())
    got = rows.select("doc_id", "y", *FEATURES).toPandas().sort_values(["doc_id", *FEATURES], kind="stable")
    if got.empty:
        return []
    order = np.random.default_rng(8).permutation(len(got))
    x = {k: got[k].to_numpy(dtype=float)[order] for k in FEATURES}
    return learn_rules(x, got["y"].to_numpy()[order] == 0)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, 0 where none does: CASE WHEN ... in the list's order."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """stats with base_failed, rejected_by (number of the rule, 0: none) and kept."""
    out = with_features(stats).withColumn("base_failed", base_failed()).withColumn("rejected_by", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == 0))


def assess(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Statistics and verdict for each row of docs."""
    return judged(text_stats(docs), learn(docs, labels, max_labelled))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    from varaq.llm.common import table

    out = assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


#: The base columns in SQL; the method's verdict is learned.
BASE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(len(words) - 7)) AS i FROM d WHERE len(words) >= 8
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i + 1 : i + 8], ' ')) AS often FROM starts
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM windows, range(8) AS r(j) WHERE often > 1 GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_transform([list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))], lambda ls: len(ls) - len(list_distinct(ls)))[1] AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
"""


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, with their own columns. Rows are judged where they are
    read: no join, no shuffle."""
    from varaq.llm.common import table

    good = judged(with_text_stats(docs), learn(docs, table(spark, sf_dir, "labels"))).where("kept")
    return good.select("row.*")

"""Toxicity by a convolutional text classifier (operator 3), trained in numpy.

A word is the sum of hashed embeddings of itself and its first four and five letters. Filters of three widths slide
over a text, the largest answer of each filter over the whole text goes into a logistic output. Training takes a
bounded sample of labelled rows that are not held out. The decision threshold is calibrated for each language on
sampled rows kept out of the training; the language is told from the text's own function words, never from a
column. Scores are shifted so that every language's threshold is at THRESHOLD.

Defined results: texts without words, null ones included, score 0; without labelled rows of both kinds
all scores are 0; rows with a null doc_id are never learned from and count as not held out; repeated labels of a
document count once, as the lowest; each input row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varaq.llm.common import chunks, in_small_batches, table

#: Labelled rows that are learned from, at most: toxic ones, others (those with the smallest hash of doc_id).
MAX_TOXIC, MAX_OTHER = 2500, 4500
THRESHOLD = 0.7
HELD_OUT = 1
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 16, 12, (1, 2, 3)
STEPS, BATCH, RATE, DECAY, SEED = 450, 64, 0.02, 1e-5, 3
#: Sampled rows of a language that calibration needs; with fewer, the threshold over all languages holds.
LEAST_CALIBRATION = 40
#: Words whose filter answers a worker remembers.
REMEMBERED = 200_000

#: Frequent function words (fixed values), to tell the language of a text from itself.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with was on are be this",
    "fr": "le la les des et un une est pour que qui dans sur pas au",
    "de": "der die das und den von zu mit sich auf für ist nicht ein eine",
    "es": "el los las del y en por con una su para se lo como al",
}
LANGUAGES = (*FUNCTION_WORDS, "other")
_LANGUAGE_OF = {w.encode(): k for k, words in enumerate(FUNCTION_WORDS.values()) for w in words.split()}
#: ASCII characters that are no letters separate words.
_SEPARATORS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_SEPARATORS).split()


def buckets_of(words: list[bytes]) -> np.ndarray:
    """Three bucket numbers for each word."""
    from xxhash import xxh3_64_intdigest as h

    out = np.empty((len(words), 3), dtype=np.int32)
    for k, w in enumerate(words):
        letters = w.decode()
        out[k] = (h(w) % BUCKETS, h(letters[:4].encode(), 4) % BUCKETS, h(letters[:5].encode(), 5) % BUCKETS)
    return out


def language_of(words: list[bytes]) -> int:
    counts = [0] * len(LANGUAGES)
    for w in words:
        k = _LANGUAGE_OF.get(w)
        if k is not None:
            counts[k] += 1
    best = max(range(len(counts)), key=counts.__getitem__)
    return best if counts[best] else len(LANGUAGES) - 1


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # for each width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    offset: float
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    def answers(self, buckets: np.ndarray) -> np.ndarray:
        """What each word gives to each filter at each place in it: words x (sum of widths * FILTERS)."""
        e = self.embedding[buckets].sum(axis=1)
        return np.concatenate([e @ w for f in self.filters for w in f], axis=1).astype(np.float32)

    def pooled(self, table: np.ndarray, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Largest answer of each filter over each text. index: rows of table, texts one after the other and two
        padding words behind each; starts: first place of each text."""
        out, column = [], 0
        n = len(index) - 2
        for width in WIDTHS:
            total = np.zeros((n, FILTERS), dtype=np.float32)
            for j in range(width):
                total += table[index[j : j + n], column : column + FILTERS]
                column += FILTERS
            out.append(np.maximum.reduceat(total, starts, axis=0))
        return np.concatenate(out, axis=1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.offset


def _laid_out(docs: list[np.ndarray], padding: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words one after the other with two padding words behind each, and where each text starts."""
    sizes = np.fromiter((len(d) + 2 for d in docs), dtype=np.int64, count=len(docs))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flat = np.full(int(sizes.sum()), padding, dtype=np.int64)
    for s, d in zip(starts, docs, strict=True):
        flat[s : s + len(d)] = d
    return flat, starts


def train(texts: list[str], y: np.ndarray, seed: int = SEED) -> Model | None:
    """A model of texts (in a fixed order) and their labels 0/1."""
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    number: dict[bytes, int] = {}
    docs, language = [], np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):  # words become numbers text by text, so that they are not held all at once
        words = words_of(text)
        docs.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int32, count=len(words)))
        language[k] = language_of(words)
    buckets = buckets_of(list(number))
    del number
    fold = rng.permutation(len(docs)) % 5
    learn, check = np.flatnonzero(fold > 0), np.flatnonzero(fold == 0)
    model = Model(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        [rng.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), dtype=np.float32),
        np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS))).astype(np.float32) * np.tile([1, -1], FILTERS * len(WIDTHS) // 2).astype(np.float32),
        0.0,
    )
    square = np.full(BUCKETS, 1e-6, dtype=np.float32)  # Adagrad for embeddings, Adam for the rest
    dense = [*model.filters, model.bias, model.out]
    m1, m2, step, o1, o2 = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense], 0, 0.0, 0.0
    weight = {0: 1.0, 1: float(np.sqrt((y == 0).sum() / max(1, (y == 1).sum())))}
    for _ in range(max(1, min(60, round(STEPS * BATCH / len(learn))))):
        for part in np.array_split(rng.permutation(learn), max(1, len(learn) // BATCH)):
            used, inverse = np.unique(np.concatenate([docs[i] for i in part] or [np.empty(0, np.int32)]), return_inverse=True)
            at = np.cumsum([0, *(len(docs[i]) for i in part)])
            flat, starts = _laid_out([inverse[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], len(used))
            e = np.concatenate([model.embedding[buckets[used]].sum(axis=1), np.zeros((1, DIM), dtype=np.float32)])
            tab = np.concatenate([e @ w for f in model.filters for w in f], axis=1)
            n, column, pooled, place = len(flat) - 2, 0, [], []
            owner = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(flat))))[:n]
            for width in WIDTHS:
                total = np.zeros((n, FILTERS), dtype=np.float32)
                for j in range(width):
                    total += tab[flat[j : j + n], column : column + FILTERS]
                    column += FILTERS
                best = np.maximum.reduceat(total, starts, axis=0)
                hit = total == best[owner]
                first = np.where(hit, np.arange(n)[:, None], n)
                pooled.append(best)
                place.append(np.minimum.reduceat(first, starts, axis=0))
            z = np.concatenate(pooled, axis=1) + model.bias
            act = np.maximum(z, 0)
            logit = act @ model.out + model.offset
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            target = y[part]
            g = (p - target) * np.where(target == 1, weight[1], weight[0]) / len(part)
            g_out, g_off = act.T @ g + DECAY * model.out, float(g.sum())
            g_z = np.outer(g, model.out) * (z > 0)
            g_bias = g_z.sum(axis=0)
            g_e = np.zeros_like(e)
            g_filters = []
            for k, width in enumerate(WIDTHS):
                gz, where = g_z[:, k * FILTERS : (k + 1) * FILTERS], place[k]
                gf = np.zeros_like(model.filters[k])
                d, f = np.nonzero(gz)
                for j in range(width):
                    word = flat[where[d, f] + j]
                    np.add.at(gf[j].T, f, gz[d, f][:, None] * e[word])
                    np.add.at(g_e, word, gz[d, f][:, None] * model.filters[k][j].T[f])
                g_filters.append(gf)
            step += 1
            for q, (param, grad) in enumerate(zip(dense, [*g_filters, g_bias, g_out], strict=True)):
                m1[q] += 0.1 * (grad - m1[q])
                m2[q] += 0.001 * (grad * grad - m2[q])
                param -= (RATE / 4 * (m1[q] / (1 - 0.9**step)) / (np.sqrt(m2[q] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            o1, o2 = o1 + 0.1 * (g_off - o1), o2 + 0.001 * (g_off * g_off - o2)
            model.offset -= RATE / 4 * (o1 / (1 - 0.9**step)) / ((o2 / (1 - 0.999**step)) ** 0.5 + 1e-8)
            live = np.flatnonzero(np.abs(g_e[:-1]).sum(axis=1))
            for k in range(3):
                rows = buckets[used[live], k]
                np.add.at(square, rows, (g_e[live] ** 2).mean(axis=1))
                np.add.at(model.embedding, rows, -(RATE / np.sqrt(square[rows]))[:, None] * g_e[live])
    z = _logits(model, [docs[i] for i in check], buckets)
    model.shift = calibrate(z, y[check], language[check])
    return model


def _logits(model: Model, docs: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
    tab = np.concatenate([model.answers(buckets), np.zeros((1, FILTERS * sum(WIDTHS)), dtype=np.float32)])
    out = []
    for a in range(0, len(docs), 200):
        flat, starts = _laid_out(docs[a : a + 200], len(buckets))
        out.append(model.logits(model.pooled(tab, flat, starts)))
    return np.concatenate(out) if out else np.empty(0)


def _cut(z: np.ndarray, y: np.ndarray) -> float:
    """A threshold on z with the best F1, a third of the way up the gap that it lies in."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(z[1:] < z[:-1], True)
    f1 = np.where(ends, f1, -1)
    k = int(np.argmax(f1))
    return float((z[k] + 2 * z[k + 1]) / 3) if k + 1 < len(z) else float(z[k]) - 1.0


def calibrate(z: np.ndarray, y: np.ndarray, language: np.ndarray) -> np.ndarray:
    """For each language, what to add to logits so that its best threshold scores THRESHOLD."""
    goal = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    enough = lambda rows: rows.sum() >= LEAST_CALIBRATION and len(set(y[rows].tolist())) == 2
    every = np.ones(len(y), dtype=bool)
    common = goal - _cut(z, y) if len(set(y.tolist())) == 2 else 0.0
    return np.array([goal - _cut(z[language == k], y[language == k]) if enough(every & (language == k)) else common for k in range(len(LANGUAGES))])


class Scorer:
    """Scores whole texts; remembers the filter answers of words up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.answers = np.zeros((1024, FILTERS * sum(WIDTHS)), dtype=np.float32)  # row 0: padding; grows by doubling
        self.used = 1

    def score(self, texts: list[str]) -> np.ndarray:
        tokens = [words_of(t) for t in texts]
        if len(self.rows) > REMEMBERED:
            self.clear()
        new = list({w for t in tokens for w in t if w not in self.rows})
        if new:
            first, self.used = self.used, self.used + len(new)
            self.rows.update(zip(new, range(first, self.used), strict=True))
            if self.used > len(self.answers):
                grown = np.zeros((max(self.used, 2 * len(self.answers)), self.answers.shape[1]), dtype=np.float32)
                grown[:first] = self.answers[:first]
                self.answers = grown
            self.answers[first : self.used] = self.model.answers(buckets_of(new))
        get = self.rows.__getitem__
        docs = [np.fromiter(map(get, t), dtype=np.int64, count=len(t)) for t in tokens]
        flat, starts = _laid_out(docs, 0)
        z = self.model.logits(self.model.pooled(self.answers, flat, starts))
        z = z + self.model.shift[[language_of(t) for t in tokens]]
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))
        score[[not t for t in tokens]] = 0.0
        return score


_LOADED: list[Scorer] = []


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if model is not None and (not _LOADED or _LOADED[0].model is not model):
            _LOADED[:] = [Scorer(model)]
        for whole in batches:
            for batch in chunks(whole):
                texts = pc.fill_null(batch.column("text"), "").to_pylist()
                score = _LOADED[0].score(texts) if model is not None else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())], names=["doc_id", "held_out", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id").cast("bigint")))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    order = (F.xxhash64("doc_id"), "doc_id")
    sample = usable.where("y = 1").orderBy(*order).limit(MAX_TOXIC).union(usable.where("y = 0").orderBy(*order).limit(MAX_OTHER))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).toPandas()  # bounded by the two limits
    rows = rows.sort_values("doc_id")
    return train(rows["text"].tolist(), rows["y"].to_numpy(dtype=np.int64))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))  # a few MB whatever the input
    rows = in_small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id").cast("bigint")).alias("held_out"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scores(shared), "doc_id bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

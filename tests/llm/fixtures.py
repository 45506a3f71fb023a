"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns with clashing names."""

from __future__ import annotations

import random

CLASH = ("n_words", "key", "bands", "_slot", "_spans", "_row", "rep", "score", "seq", "comp", "weight", "host")


def texts(seed: int = 1, n: int = 120) -> list[str | None]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["the", "of", "Élan", "x" * 60, "a@b.example.com", "4111 1111 1111 1111", "10.0.0.1", "+1 (017) 555-7713"]
    out: list[str | None] = [None, "", "  \n\t ", "one", "one two three four", "one two three four five", "a" * 3000, "z " * 4000]
    for _ in range(n):
        out.append(" ".join(rng.choices(words, k=rng.randint(5, 120))) + rng.choice(["", "\n", "\nline\nline\n", " ### $$ "]))
    base = rng.choices(words, k=100)
    for _ in range(25):  # near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out + [out[20]] * 6 + [out[30]] * 2


def documents(spark, seed: int = 1):
    rows = [(k, t, "en", "src0" if k % 3 == 0 else None if k % 17 == 1 else "" if k % 17 == 2 else f"src{k % 7}", len(t or "")) for k, t in enumerate(texts(seed))]
    rows.append((None, "a row without an id but with words enough to count", None, None, None))
    rows.append(rows[40])  # a repeated row
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("clash").alias(c) for c in CLASH))


def empty(spark):
    return documents(spark).limit(0)

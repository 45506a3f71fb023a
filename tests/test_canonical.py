"""Canonical concepts against union-find over all pairs of names."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from varaq.operators import canonical


def plain(names):
    """name -> least name of its component, comparing all pairs."""
    up = {n: n for n in names}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in names:
        for b in names:
            x, y = set(a.split()), set(b.split())
            if a < b and x and y and 5 * len(x & y) >= 4 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                up[hi] = lo
    return {n: root(n) for n in names}


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(12)] + ["the", "the2"]
    names = {" ".join(sorted(set(rng.choices(words, k=rng.randint(1, 11))))) for _ in range(220)} | {"", "جامعه کنش"}
    base = sorted(f"x{k}" for k in range(9))
    chain = [" ".join(sorted({*base[k:], *(f"y{j}" for j in range(k))})) for k in range(10)]  # each next to the last one
    names = sorted(names | set(chain))
    df = spark.createDataFrame([(n,) for n in names], "name string")
    want = plain(names)
    pairs = canonical.similar_names(df)
    near = {(a, b) for a in names for b in names if a < b and a and 5 * len(set(a.split()) & set(b.split())) >= 4 * len(set(a.split()) | set(b.split()))}
    assert {tuple(r) for r in pairs.collect()} == near and near
    assert {r.name: r.least for r in canonical.components(df, pairs).collect()} == want
    assert len({want[c] for c in chain}) == 1
    assert canonical.components(df.limit(0), pairs.limit(0)).count() == 0


def test_vertices_edges_and_sources_of_several_books(spark):
    ref = lambda f, p: [(f, p, None)]
    rows = [
        ("a", "lesson-1:x", "كنش اجتماعی", 0.5, ref("a.pdf", 1)),  # Arabic kaf
        ("b", "lesson-1:x", "کنش  اجتماعی!", 0.9, ref("b.pdf", 7)),
        ("b", "lesson-2:y", "Social Structure", 0.7, ref("b.pdf", 9)),
        ("a", "lesson-2:y", "structure social", 0.7, ref("b.pdf", 9)),
        ("a", "lesson-3:z", "?!", 0.1, None),
    ]
    v = spark.createDataFrame(rows, "book string, id string, title string, confidence double, source_refs array<struct<filename:string,page:bigint,block_id:string>>")
    owned = canonical.assigned(v).persist()
    got = {r.concept: r for r in canonical.concepts(owned).collect()}
    assert len(got) == 3
    name = lambda t: "concept-" + hashlib.sha256(" ".join(sorted(set(re.findall(r"\w+", t.lower())))).encode()).hexdigest()[:16]
    action, structure, none = got[name("کنش اجتماعی")], got[name("social structure")], got[name("")]
    assert (action.title, action.vertices, action.books, [r.filename for r in action.source_refs]) == ("کنش  اجتماعی!", 2, 2, ["a.pdf", "b.pdf"])
    assert (structure.title, len(structure.source_refs), none.vertices, none.source_refs) == ("Social Structure", 1, 1, [])
    e = spark.createDataFrame([("a", "lesson-1:x", "lesson-2:y", "related"), ("b", "lesson-1:x", "lesson-2:y", "related"), ("a", "lesson-2:y", "lesson-2:y", "similar"), ("c", "lesson-1:x", "lesson-2:y", "related")], "book string, source_id string, target_id string, type string")
    assert [tuple(r) for r in canonical.edges(e, owned).collect()] == [(action.concept, structure.concept, "related", 2)]
    again = canonical.assigned(v.orderBy(F.desc("id")).repartition(3))
    assert sorted(map(tuple, again.select("book", "id", "concept").collect())) == sorted(map(tuple, owned.select("book", "id", "concept").collect()))
    owned.unpersist()

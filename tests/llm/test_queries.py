"""The registered queries: against their SQL, the base columns' SQL, plain versions and the tokenizer libraries."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, texts
from tests.test_oracle import TABLES, normal
from varaq.llm import byte_bpe, mixing, pii, quality, queries, token_count, toxicity

P = pytest.importorskip("public_tokenizers")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder whose documents hold nulls, empty and long texts, personal data and repeated lines, each id once."""
    path = tmp_path_factory.mktemp("odd")
    more = ["a.b@c.de x@y 1.2.3.4 1.2.3.400 4111-1111-1111-1111 41111111111111112 +1 (017) 555-7713 +12 3", "é😀 a@b.co,+49 30 1234567 10.0.0.1.5", "l\nl\n \nl\n" + "a b c d e f g h " * 9, None]
    rows = [(k, t, "en", f"s{k % 4}" if k % 9 else None, len(t or "")) for k, t in enumerate(texts(3) + more)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(0, 150, 3)], "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"file://{path}/labels.parquet")
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    return f"file://{path}", c


def compared(df, duck, sql, only=False):
    result = duck.execute(sql)
    names = [x[0] for x in result.description]
    want = result.fetchall()
    columns = sorted(names) if only else sorted(df.columns)
    assert sorted(names) == columns
    got = normal(tuple(r) for r in df.select(*columns).collect())
    assert got == normal(tuple(x[names.index(c)] for c in columns) for x in want) and got


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, duck, name):
    compared(queries.queries()[name](spark, sf), duck, queries.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op2_mixing", "op4_pii", "op7_sharding", "op9_minhash"])
def test_query_equals_its_sql_on_odd_documents(spark, odd, name):
    compared(queries.queries()[name](spark, odd[0]), odd[1], queries.oracle_sql()[name])


@pytest.mark.parametrize("module, query", [(quality, quality.op8_quality), (pii, pii.op4_pii)])
def test_base_columns_equal_their_sql(spark, sf, duck, odd, module, query):
    compared(query(spark, sf), duck, module.BASE_SQL, only=True)
    compared(query(spark, odd[0]), odd[1], module.BASE_SQL, only=True)


def test_verdict_of_the_quality_query(spark, sf):
    """kept is what the list's rules say, in their order, on the statistics; labels that repeat a document count once."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.learn(docs, labels)
    assert rules == quality.learn(docs.union(docs), labels.union(labels))
    x = {r.doc_id: r for r in quality.with_features(quality.text_stats(docs)).collect()}
    for r in quality.op8_quality(spark, sf).collect():
        by = next((k for k, rule in enumerate(rules, 1) if all((x[r.doc_id][c.feature] >= c.value) == c.at_least or x[r.doc_id][c.feature] == c.value for c in rule)), 0)
        assert (r.rejected_by, r.kept) == (by, not r.base_failed and not by)


def test_a_repeated_labelled_document_comes_to_the_driver_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, " ".join(f"w{j}" for j in range(40)))] * 500 + [(2, " ".join(f"v{j}" for j in range(40)))], "doc_id bigint, text string")
    seen = []
    monkeypatch.setattr(quality, "learn_rules", lambda x, y: seen.append(len(y)) or [])
    quality.learn(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, quality int"))
    assert seen == [2]


def test_token_queries_equal_the_libraries(spark, odd):
    tokenizers, tiktoken = pytest.importorskip("tokenizers"), pytest.importorskip("tiktoken")
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{odd[0]}/documents.parquet").collect()}
    t = tokenizers.Tokenizer.from_file(P.path(token_count.VOCABULARY))
    want = {k: len(t.encode(x, add_special_tokens=False).ids) for k, x in docs.items()}
    got = {r.doc_id: r for r in token_count.op5_token_count(spark, odd[0]).collect()}
    assert {k: (r.n_tokens, r.n_bytes, r.over_limit) for k, r in got.items()} == {k: (want[k], len(x.encode()), want[k] > 2048) for k, x in docs.items()}
    from tests.llm.test_text_operators import tiktoken_ids

    ids = dict(zip(docs, tiktoken_ids(list(docs.values())), strict=True))
    for r in byte_bpe.op6_byte_bpe(spark, odd[0]).collect():
        packed = b"".join(i.to_bytes(4, "little") for i in ids[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids[r.doc_id]), hashlib.sha256(packed).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_toxicity_query_has_the_contract_columns(spark, sf):
    import zlib

    rows = toxicity.op3_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


# the disclosing terms, plainly


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
}


def plain_added_spans(rows):
    """The spans that the method adds, from its definition. rows: doc_id, text, with e-mails and IPs, each once a text."""
    n = len(rows)
    spans = {k: sorted((m.start(), list(BASE).index(kind), m.end(), m[0]) for kind, p in BASE.items() for m in re.finditer(p, t)) for k, t in rows}
    text = dict(rows)
    word = re.compile(r"[^\W_]+")
    in_docs = {}
    for t in text.values():
        for w in {x.lower() for x in word.findall(t)}:
            in_docs[w] = in_docs.get(w, 0) + 1
    stands = {}
    for k, found in spans.items():
        for a, kind, b, x in found:
            stands.setdefault((kind, x.lower()), {})[k] = (text[k][max(0, a - 160) : a].lower(), text[k][b : b + 160].lower())
    entities = {}
    for v, at in stands.items():
        entities.setdefault(frozenset(at), []).append(v)
    terms = {k: {} for k in text}
    for k, found in spans.items():
        for m in word.finditer(text[k]):
            if not any(a < m.end() and m.start() < b for a, _, b, _ in found):
                terms[k].setdefault(m[0].lower(), []).append((m.start(), m.end()))
    rated, among = [], 0
    for docs, values in entities.items():
        at = stands[min(values, key=lambda v: f"{v[0]}:{v[1]}")]
        n_value = len(set(at.values()))
        if n_value < 2:
            continue
        among += 1
        for w in {w for k in docs for w in terms[k]}:
            both = [k for k in docs if w in terms[k]]
            hits = len({at[k] for k in both})
            if hits < 2 or in_docs[w] > len(docs) + min(n_value * (n / n_value) ** 0.2, 10 * n_value):
                continue
            mean = n_value * in_docs[w] / n
            bits = min(math.floor(hits * math.log2(hits / mean) - (hits - mean) / math.log(2)), 1000) if hits > mean else 0
            rated.append((bits, w, both, hits, n_value))
    tests = among * sum(c >= 2 for c in in_docs.values())
    passing = [b for b, *_ in rated if tests * 0.5**b <= 0.05 * sum(x[0] >= b for x in rated)]
    marked = {}
    for bits, w, both, hits, n_value in rated:
        of = hits + max(in_docs[w] - len(both), 0)
        p, z = hits / of, 1.645**2
        low = (p + z / (2 * of) - 1.645 * math.sqrt(p * (1 - p) / of + z / (4 * of * of))) / (1 + z / of)
        content = math.log2(n / n_value)
        told = 1 + math.log2(low) / content if content > 0 else 0
        if passing and bits >= min(passing) and told >= 0.8 and low >= 0.1:
            for k in both:
                marked[k, w] = min(marked.get((k, w), "term"), "cue" if told >= 0.95 else "term")  # the stricter
    out = {k: set() for k in text}
    for (k, w), kind in marked.items():
        out[k] |= {(a, b, kind) for a, b in terms[k][w] if not any(s <= b and a <= e for s, _, e, _ in spans[k])}
    return out


def planted(n=1600, entities=40, seed=5):
    """Documents of common words; entities with an e-mail or an IP of their own, and two words that only they have."""
    rng = random.Random(seed)
    common = [f"word{k}" for k in range(60)]
    rows, secret = [], {}
    for e in range(entities):
        value = f"person{e}@mail{e}.example.com" if e % 3 else f"10.{e}.0.9"
        own = [f"title{e}x", f"place{e}y"]
        for _ in range(1 + e % 7):
            k = len(rows)
            rows.append((k, " ".join([*rng.choices(common, k=30), own[0], *rng.choices(common, k=5), value, *rng.choices(common, k=25), own[1], *rng.choices(common, k=9)])))
            secret[k] = own
    while len(rows) < n:
        rows.append((len(rows), " ".join(rng.choices(common, k=rng.randint(5, 90)) + [f"rare{len(rows) % 97}"])))
    return rows, secret


def test_added_spans_equal_the_plain_definition_and_find_planted_terms(spark):
    rows, secret = planted()
    got = {r.doc_id: {(s.start, s.end, pii.KINDS[s.k]) for s in r._all if s.k >= pii.BASE_KINDS} for r in pii.with_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == plain_added_spans(rows)
    text = dict(rows)
    shown = {k: {text[k][a:b] for a, b, _ in x} for k, x in got.items()}
    often = [own[0] for own in secret.values()]
    more = {k: own for k, own in secret.items() if often.count(own[0]) > 1}
    hidden = sum(w in shown[k] for k, own in more.items() for w in own)
    assert hidden >= 0.95 * 2 * len(more)  # recall on planted quasi-identifiers
    assert not any(shown[k] for k in secret.keys() - more.keys())  # one witness is no evidence
    assert not any(w.startswith("word") or w.startswith("rare") for x in shown.values() for w in x)


def test_pii_query_lists_all_spans(spark, tmp_path):
    rows, _ = planted(900, 12)
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    want = plain_added_spans(rows)
    for r in pii.op4_pii(spark, f"file://{tmp_path}").collect():
        listed = [x.split(":") for x in r.spans.split(",") if x]
        assert {(int(a), int(b), k) for k, a, b in listed if k in pii.KINDS[pii.BASE_KINDS :]} == want[r.doc_id]
        base = ",".join(":".join(x) for x in listed if x[0] in pii.KINDS[: pii.BASE_KINDS])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [int(x[1]) for x in listed] == sorted(int(x[1]) for x in listed)


@pytest.mark.parametrize("n", [2000, 20000])
def test_words_that_only_chance_brings_beside_values_stay(spark, n):
    """Values of up to three documents among words of all frequencies, drawn independently; the same at either size."""
    rng = random.Random(n)
    some = lambda k: [f"w{int(rng.paretovariate(0.6)) % 50_000}" for _ in range(k)]
    rows = [(k, " ".join([*some(20), f"p{k // 3}@x.example.com" if k % 5 < 2 else "", *some(20)])) for k in range(n)]
    out = pii.with_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    more = out.agg(F.sum(F.size(F.filter("_all", lambda s: s["k"] >= pii.BASE_KINDS)))).first()[0]
    assert more <= 0.001 * 40 * n * 2 / 5  # of the words beside values


def test_pii_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    assert pii.op4_pii(spark, f"file://{tmp_path}").count() == 0


def test_bits_needed_is_the_step_up_rule():
    assert pii.bits_needed({}, 0) == pii.bits_needed({3: 5}, 1000) == pii.MOST_BITS + 1
    assert pii.bits_needed({20: 1, 12: 9, 11: 1, 2: 500}, 2000) == 12


# mixing


def test_weights_are_kept_to(spark):
    rows = [(k, "abc"[k % 3]) for k in range(9000)] + [(9001 + k, None) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string")
    weights = {"a": 3.0, "b": 1.0, "c": -2.0, "": 1.0, "absent": 5.0}
    out = mixing.mixed(df, block=8, weights=weights).where("_in_mix").collect()
    run, share = {}, {"a": 0.6, "b": 0.2, "": 0.2, "c": 0.0}
    order = sorted({(r._slot, r._source) for r in out})
    assert len(order) > 100
    for t, (_, source) in enumerate(order, 1):
        run[source] = run.get(source, 0) + 1
        assert all(abs(run.get(q, 0) - t * x) < 1 + 0.004 * t for q, x in share.items())  # one slot of 1000 for each source
    assert mixing.mixed(df, weights={}).count() == len(rows)
    with pytest.raises(ValueError):
        mixing.mixed(df.withColumn("_SLOT", F.lit(1)))


def test_rows_without_ids_are_spread_and_ranked_alike(spark):
    docs = documents(spark).drop("_slot")
    rows = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    one, two = (sorted((r.text or "", r._slot, r._place) for r in mixing.mixed(x, block=4).collect()) for x in (rows, rows.repartition(7)))
    assert one == two

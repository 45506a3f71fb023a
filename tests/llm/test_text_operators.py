import base64
import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import CLASH, documents, empty, texts
from varaq.llm import byte_bpe, minhash, mixing, pii, quality, token_count, toxicity

P = pytest.importorskip("public_tokenizers")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# quality rules


def stats(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_quality_statistics_match_brute_force(spark):
    docs = documents(spark)
    got = by_id(quality.text_stats(docs).where("doc_id is not null"))
    for k, t in enumerate(texts()):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats(t or ""), k


def test_quality_learns_a_planted_rule_and_keeps_the_rest(spark):
    docs = documents(spark)
    labels = quality.text_stats(docs).select("doc_id", F.when(F.col("n_symbols") > 2, 0).otherwise(1).alias("quality"))
    out = quality.assess(docs, labels)
    assert out.count() == docs.count()
    wrong = out.where("not base_failed and n_words > 0").where("kept <> (n_symbols <= 2)").count()
    assert wrong <= 3
    none = labels.limit(0)
    assert quality.assess(docs, none).where("kept = base_failed").count() == 0
    assert quality.assess(empty(spark), none).count() == 0


def test_quality_stage_keeps_rows_without_an_id(spark, tmp_path):
    docs = documents(spark)
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"file://{tmp_path}/labels.parquet")
    out = quality.keep_good(spark, docs.withColumn("text", F.when(F.col("doc_id").isNull(), F.repeat(F.lit("many words that differ "), 2)).otherwise(F.col("text"))), f"file://{tmp_path}")
    assert out.columns == docs.columns
    good = {k for k, t in enumerate(texts()) if (s := stats(t or ""))[0] >= 20 and 100 * s[4] <= 30 * s[0]}
    assert {r.doc_id for r in out.collect()} == good
    long = docs.withColumn("text", F.lit(" ".join(f"w{k}" for k in range(30))))
    assert quality.keep_good(spark, long, f"file://{tmp_path}").where("doc_id is null").count() == 1


def test_quality_conditions_become_ordered_case_expressions():
    c = quality.Condition("symbols_per_char", True, 0.5)
    e = quality.Condition("chars_per_word", False, 2.0)
    assert quality.learn_rules({k: [] for k in quality.FEATURES}, __import__("numpy").array([], dtype=bool)) == []
    text = str(quality.verdict([(c, e), (e,)]))
    assert text.index("symbols_per_char") < text.rindex("chars_per_word") and "CASE WHEN" in text


# MinHash


def components(ts):
    sets, root = {}, {}
    for k, t in ts.items():
        w = (t or "").encode().lower().split()
        sets[k] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
        root[k] = k

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in ids}


def test_near_duplicates_match_brute_force(spark):
    docs = documents(spark)
    got = minhash.near_duplicates(docs)
    assert got.count() == docs.count()
    rows = by_id(got.where("doc_id is not null"))
    want = components(dict(enumerate(texts())))
    assert {k: (r.n_shingles, r.component_id) for k, r in rows.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())
    odd = got.where("doc_id is null").first()
    assert odd.component_id is None and odd.kept
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_open_groups_are_compared_in_blocks(spark, monkeypatch):
    """Chains of near copies whose members do not all reach a centre."""
    words = [f"v{k}" for k in range(120)]
    chain = {}
    for k in range(40):
        w = list(words)
        for j in range(k):
            w[3 * j % 120] = f"n{j}"
        chain[k] = " ".join(w)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    df = spark.createDataFrame(list(chain.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == components(chain)


def test_pipeline_stage_keeps_one_of_each(spark):
    docs = documents(spark)
    out = minhash.keep_one_of_each(spark, docs, "")
    assert out.columns == docs.columns
    want = {k for k, (_, c) in components(dict(enumerate(texts()))).items() if k == c}
    assert {r.doc_id for r in out.select("doc_id").collect()} - {None} == want


# PII

BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
HARD = ["1.2.3.4.5.6.7.8 0256.001.1.1 255.255.255.255 999.1.1.1", "a@b.com_x@d.org+foo bar@x.y a@b", "4111 1111 1111 1111 " * 3, "4" * 20000, "1 " * 9000, "a" * 20000, "+1 (017) 555-7713 +44 20 7946 0958", "😀 a@b.cc é 4111111111111111", None, ""]


def luhn(digits):
    doubled = (sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return sum(doubled) % 10 == 0


def base_spans(t):
    out = []
    for k, p in enumerate(BASE):
        for m in re.finditer(p, t):
            digits = re.sub("[^0-9]", "", m.group())
            ok = k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split(".")) or k == 2 and 14 <= len(digits) <= 19 and luhn(digits) or k == 3 and 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_match_the_plain_patterns(spark):
    ts = texts() + HARD
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string")
    got = by_id(pii.with_base_spans(df, "text", "s"))
    for k, t in enumerate(ts):
        assert [(s.start, s.k, s.end) for s in got[k].s] == base_spans(t or ""), k


def test_terms_that_give_a_value_away_are_added_and_replaced(spark):
    rows = [(k, f"note {k} from zebulon quartz mail secret.person@x.example.com about the matter {k * 7}") for k in range(6)]
    rows += [(100 + k, f"plain text about the matter from nobody number {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    out = by_id(pii.with_spans(df).select("doc_id", "text", "_all"))
    words = {out[0].text[s.start : s.end] for s in out[0]._all if s.k >= pii.BASE_KINDS}
    assert {"zebulon", "quartz"} <= words and "the" not in words and "about" not in words
    assert all(not r._all for k, r in out.items() if k >= 100)
    clean = by_id(pii.sanitise(spark, df, ""))
    assert "zebulon" not in clean[0].text and "[EMAIL]" in clean[0].text and clean[0].n_chars == len(clean[0].text)
    assert clean[100].text == rows[6][1]


def test_terms_of_rare_values_are_weighed_by_their_counts(spark):
    far = "about the matter " * 20  # over 300 code points
    rows = [(0, f"quorlin {far} solitary.one@x.example.com {far} vastrel, 10.0.0.1 the"), (1, f"zoltun {far} pair@x.example.com"), (2, f"number 2 {far} pair@x.example.com zoltun")]
    rows += [(10 + k, f"dupli {far} copied@x.example.com same") for k in range(4)]  # copies are one document
    rows += [(100 + k, f"{far} w{k % 9} number {k} " + "shared " * (k % 200 == 0)) for k in range(2000)] + [(5000, f"shared {far} third@x.example.com")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: {(r.text[s.start : s.end], pii.KINDS[s.k]) for s in r._all if s.k >= pii.BASE_KINDS} for r in pii.with_spans(df).collect()}
    assert got[0] == set()  # every word stands beside it in its one document
    assert got[1] == {("zoltun", "term")} == got[2] and got[5000] == set()
    assert got[10] == got[13] == set()
    assert not any(v for k, v in got.items() if 100 <= k < 5000)


def test_sanitise_keeps_rows_columns_and_clashing_names(spark):
    docs = documents(spark)
    out = pii.sanitise(spark, docs, "")
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(out.where(F.col(c) != "clash").count() == 0 for c in CLASH)
    assert pii.sanitise(spark, empty(spark), "").count() == 0


# tokens


def tiktoken_ids(ts):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(byte_bpe.VOCABULARY), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [enc.encode_ordinary(t) for t in ts]


ODD = ["\x1c\x85　 x", "<|endoftext|>", "😀" * 50, "naïve ﬁ Ǆ ΑΣ ΣΑΣ İ", "it's THE'LL we'Re", "ab" * 700, " " * 900, "\n" * 300 + "x", "é" * 500, "<|startoftext|>a<|endoftext|>"]


def test_byte_bpe_equals_the_library_and_round_trips(spark):
    ts = texts() + ODD
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string")
    want = tiktoken_ids([t or "" for t in ts])
    got = by_id(byte_bpe.round_trip(df))
    for k, ids in enumerate(want):
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = (ts[k] or "").encode()
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text).hexdigest()), k
    back = by_id(byte_bpe.decode(byte_bpe.encode(df)))
    assert all(bytes(back[k].data) == (t or "").encode() for k, t in enumerate(ts))
    assert byte_bpe.round_trip(empty(spark)).count() == 0


def test_long_pieces_merge_as_short_ones_do():
    bpe = byte_bpe.ByteBpe(*byte_bpe.read_vocabulary())
    for piece in (b"indivisibility", b"aaaaaaaa", b"thethethe", bytes(range(128, 160))):
        leaves = 1 << (len(piece) - 1).bit_length()
        assert bpe._merge_long(piece) == bpe._merge_many([piece, piece], leaves)[0]


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    bpe = byte_bpe.ByteBpe(*byte_bpe.read_vocabulary())
    ts = [t or "" for t in texts()]
    got = [x for a in range(0, len(ts), 10) for x in bpe.encode_batch(ts[a : a + 10])]
    assert [len(x) // 4 for x in got] == [len(x) for x in tiktoken_ids(ts)]


def test_token_counts_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    ts = texts() + ODD
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string")
    t = tokenizers.Tokenizer.from_file(P.path(token_count.VOCABULARY))
    got = by_id(token_count.token_counts(df))
    for k, e in enumerate(t.encode_batch([x or "" for x in ts], add_special_tokens=False)):
        assert (got[k].n_tokens, got[k].n_bytes) == (len(e.ids), len((ts[k] or "").encode())), k
        assert got[k].over_limit == (len(e.ids) > 2048)
    assert token_count.token_counts(empty(spark)).count() == 0


# mixing


def test_mix_keeps_every_window_and_deviates_less_than_a_block(spark):
    rows = [(k, "big" if k % 2 else f"s{k % 5}") for k in range(3000)] + [(9000 + k, None) for k in range(40)] + [(9100, ""), (9100, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string").withColumn("_slot", F.lit("clash")).drop("_slot")
    out = mixing.mixed(df, block=8).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id, r.source or "") for r in out) == sorted((a, b or "") for a, b in rows)
    blocks = {(r._source, r._block): (r._slot, r._release, r._deadline) for r in out}
    assert len({s for s, _, _ in blocks.values()}) == len(blocks)
    assert all(r <= s < d for s, r, d in blocks.values())
    totals = {}
    for r in out:
        totals[r._source] = totals.get(r._source, 0) + 1
    quota = {r.source: (r.n, r.period) for r in mixing.quotas(spark.createDataFrame(list(totals.items()), "source string, rows bigint")).collect()}
    assert sum(n for n, _ in quota.values()) == next(iter(quota.values()))[1]
    horizon = min(s for r in [0] for s in [max((x._slot for x in out if x._in_mix), default=-1) + 1])
    order = sorted((s, key[0]) for key, (s, _, _) in blocks.items() if s < horizon)
    assert [s for s, _ in order] == list(range(horizon))
    run = dict.fromkeys(quota, 0)
    for t, (_, source) in enumerate(order, 1):
        run[source] += 1
        assert all(abs(run[q] - t * n / p) < 1 for q, (n, p) in quota.items())
    sizes = {}
    for r in out:
        sizes[r._source, r._block] = sizes.get((r._source, r._block), 0) + 1
    assert all(n == 8 for (s, b), n in sizes.items() if b < math.ceil(totals[s] / 8) - 1)


def test_mix_of_an_empty_table_and_the_stage_order(spark):
    docs = documents(spark).drop("_slot")
    assert mixing.mixed(empty(spark).drop("_slot")).count() == 0
    out = mixing.in_mixed_order(spark, documents(spark), "")
    assert out.columns == documents(spark).columns and out.count() == docs.count()
    assert all(out.where(F.col(c) != "clash").count() == 0 for c in CLASH)


# toxicity


def test_classifier_learns_planted_words_and_scores_whole_texts(spark):
    import random

    rng = random.Random(5)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "se") for b in ("tan", "vor", "nel", "dis", "qua")] + ["the", "of", "and"]
    rows, labels = [], []
    for k in range(900):
        w = rng.choices(plain, k=rng.randint(20, 80))
        y = int(k % 4 == 0)
        if y:
            for bad in rng.choices(["gromlit", "vexnar", "plukdo"], k=2):
                w.insert(rng.randrange(len(w)), bad)
        rows.append((k, " ".join(w)))
        labels.append((k, y))
    rows += [(5000, None), (5001, ""), (None, "the of"), (5002, "ka " * 9000 + "gromlit vexnar")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(0, 1), (None, 1), (7, None)], "doc_id bigint, toxic int")
    out = by_id(toxicity.scored(docs, lab))
    held = [k for k, _ in labels if out[k].held_out]
    assert len(held) > 200 and not out[None].held_out
    right = sum(out[k].predicted == (k % 4 == 0) for k in held)
    assert right >= 0.98 * len(held)
    assert out[5002].predicted == 1 and out[5000].predicted == 0 and out[5000].score == out[5001].score
    assert all(0 <= r.score <= 1 for r in out.values())
    assert toxicity.scored(docs, lab.limit(0)).where("score <> 0").count() == 0

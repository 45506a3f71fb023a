import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty
from varaq.llm import compaction, graph_dedup, html_extract
from varaq.llm.components import components


def test_components_of_chains_hubs_and_loops(spark):
    pairs = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(7, 7), (500, 400), (400, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 1 for k in range(1, 40))
    assert got[500] == got[400] == 400
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# embeddings


def vectors():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for size in (1, 1, 1, 30, 12, 2, 60):
        for _ in range(6 if size == 1 else 1):
            centre = rng.normal(size=16)
            for _ in range(size):
                rows.append((k, (centre + rng.normal(size=16) * 0.08 * np.linalg.norm(centre) / 4).astype(np.float32).tolist()))
                k += 1
    rows += [(k + j, rows[25][1]) for j in range(5)]
    k += 5
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(k + j, v) for j, v in enumerate(bad)]
    return rows


def brute(rows):
    ok = [(k, np.array(v, dtype=np.float32).astype(np.float64)) for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    n, root = {k: 0 for k, _ in rows}, {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(ok):
        for b, y in ok[:i]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= graph_dedup.COSINE:
                n[a], n[b] = n[a] + 1, n[b] + 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: (n[k], find(k)) for k, _ in rows}


@pytest.mark.parametrize("part", [1500, 20])
def test_links_match_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(graph_dedup, "PART", part)
    monkeypatch.setattr(graph_dedup, "PER_CENTRE", 40)
    rows = vectors()
    df = spark.createDataFrame([*rows, (None, [1.0] * 16), rows[3]], "vec_id bigint, embedding array<float>").withColumn("weight", F.lit("clash"))
    out = graph_dedup.linked(df)
    assert out.count() == len(rows) + 2
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.where("vec_id is not null").collect()}
    assert got == brute(rows)
    assert out.where("kept <> (vec_id = component_id)").count() == 0
    assert graph_dedup.linked(df.limit(0)).count() == 0


def test_links_of_a_length_that_the_sample_lacks(spark, monkeypatch):
    monkeypatch.setattr(graph_dedup, "SAMPLE", 3)
    rows = vectors()
    late = [r.vec_id for r in spark.range(10_000, 40_000).withColumnRenamed("id", "vec_id").orderBy(F.desc(F.xxhash64("vec_id"))).limit(3).collect()]
    rows += [(k, [1.0, 2.0, 3.0 + j / 100]) for j, k in enumerate(late)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in graph_dedup.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()}
    assert got == brute(rows) and all(got[k] == (2, min(late)) for k in late)


def test_vectors_are_compared_in_double(spark):
    rows = [(1, [1e-46, 2e-46]), (2, [1e-46, 2e-46]), (3, [1e39, 2e39]), (4, [1e39, 2.1e39]), (5, [1e200, -1e200]), (6, [1e-320, 0.0]), (7, [1.0, 1e-9])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in graph_dedup.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert got == {**{k: (3, 1) for k in (1, 2, 3, 4)}, 5: (0, 5), 6: (1, 6), 7: (1, 6)}


def grouped(n: int, dim: int = 24):
    """Vectors in groups of 1 to 60, links within groups only; every twentieth id is a query."""
    rng = np.random.default_rng(7)
    rows = []
    while len(rows) < n:
        centre = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 1, 1, 2, 3, 8, 60]))):
            rows.append((len(rows), (centre + rng.normal(size=dim) * 0.25).tolist()))
    return rows


@pytest.mark.parametrize("part", [12_000, 400])
def test_recall_over_shards_of_queries_that_have_links(spark, monkeypatch, part):
    """With the audits' ways out switched off: the graph alone finds the links, over many shards and parts."""
    rows = grouped(4000)
    x = graph_dedup.unit([v for _, v in rows])
    near = x @ x.T >= graph_dedup.COSINE
    want = near.sum(axis=1) - 1
    monkeypatch.setattr(graph_dedup, "PER_CENTRE", 150)
    monkeypatch.setattr(graph_dedup, "PART", part)
    monkeypatch.setattr(graph_dedup, "PART_AUDIT", 0)
    monkeypatch.setattr(graph_dedup, "LEAST_RECALL", 0.0)
    out, audit = graph_dedup.linked_and_audited(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = np.array([r.n_links for r in out.orderBy("vec_id").collect()])
    asked = (np.arange(len(rows)) % 20 == 0) & (want > 0)
    assert asked.sum() > 50 and (got <= want).all()
    assert np.minimum(got, want)[asked].sum() >= 0.98 * want[asked].sum()
    assert audit.links > 100 and audit.recall >= 0.95
    assert got.sum() % 2 == 0  # both ends of a link agree on it


def test_search_finds_groups_without_comparing_all(monkeypatch):
    rows = grouped(3000)
    x = graph_dedup.unit([v for _, v in rows])
    pruned = graph_dedup.robust_prune(x)
    assert max(map(len, pruned)) <= graph_dedup.DEGREE
    r, v = graph_dedup.search(x, graph_dedup.both_ways(pruned, len(x)), x, np.arange(len(x)))
    q, w = graph_dedup.in_full(x, x, np.arange(len(x)))
    found, every = set(zip(r.tolist(), v.tolist())), set(zip(q.tolist(), w.tolist()))
    assert found <= every and len(found) >= 0.99 * len(every)
    r, v = graph_dedup.search(x, graph_dedup.both_ways(pruned, len(x)), x[:500], np.full(500, -1))  # from the medoids alone
    assert len(set(zip(r.tolist(), v.tolist()))) >= 0.6 * sum(a < 500 for a, _ in every)


def test_a_large_shard_is_clustered_again(spark, monkeypatch):
    rows = grouped(3000)
    monkeypatch.setattr(graph_dedup, "MAX_CENTRES", 4)
    monkeypatch.setattr(graph_dedup, "PER_CENTRE", 200)
    monkeypatch.setattr(graph_dedup, "PART", 600)
    got = {r.vec_id: (r.n_links, r.component_id) for r in graph_dedup.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    x = graph_dedup.unit([v for _, v in rows])
    q, w = graph_dedup.in_full(x, x, np.arange(len(x)))
    root = graph_dedup.unite(np.arange(len(x)), q, w)
    assert got == {k: (int(n), int(c)) for k, n, c in zip(range(len(x)), np.bincount(q, minlength=len(x)), root, strict=True)}


def test_graph_query_equals_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame(vectors(), "vec_id bigint, embedding array<float>").coalesce(1).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = c.execute(graph_dedup.OP1_SQL).fetchall()
    got = graph_dedup.op1_graph_dedup(spark, f"file://{tmp_path}").select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(r[1] > 50 for r in want)


def test_robust_pruning_drops_occluded_neighbours():
    x = graph_dedup.unit([[1, 0.02 * k] for k in range(10)])
    out = graph_dedup.robust_prune(x)
    assert out[0].tolist() == [1]  # all others lie behind the nearest
    assert set(out[5].tolist()) == {4, 6}


# HTML


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu</a></li></ul></nav><header><h1>site</h1></header><!-- ad <p>no</p> --><div class="ad">buy</div>
<article><h1>Head  &amp; tail</h1><p><b>one\n two<br><p>three &lt;4&gt; &copy;</p><aside>side</aside><form><p>no</p></form><div class="comments"><p>no</p></div>
<p hidden>no</p><p class="lead">five</p><table><tr><td>c1</td><td>c2</td></tr></table></article><footer>foot</footer></body></html>"""


def test_blocks_of_an_article():
    assert html_extract.text_lines(PAGE) == (True, ["Head & tail", "one two", "three <4> ©", "five", "c1", "c2"])
    assert html_extract.text_lines("") == (False, [])
    assert html_extract.text_lines("plain <b>text") == (False, ["plain text"])
    assert html_extract.text_lines("<div>a<div>b</div>c</div><p>d<p>e") == (False, ["a", "b", "c", "d", "e"])
    assert html_extract.text_lines("<article><p>cut &am")[1] == ["cut &am"]
    shell = '<div class="page has-sidebar"><main><p>in</p><ol class="commentList"><li>no</li></ol></main><section id="relatedPosts"><p>no</p></section></div>'
    assert html_extract.text_lines(shell) == (True, ["in"])
    assert html_extract.text_lines('<article>a</article><article class="comment">no</article>') == (True, ["a"])
    assert html_extract.text_lines("<body><div role=navigation>no</div><p>yes<noscript>no</noscript></p><div style='display: none'>no</div>") == (False, ["yes"])
    kept = '<p class="related-work">a</p><section id="social-policy"><p>b</p></section><div class="notice-board">c</div><label>d</label>'
    beside = '<div class="related-posts">n</div><div id="articleComments2">n</div><ul class="x share_buttons">n</ul><div class="ad-slot-top">n</div><button>n</button>'
    assert html_extract.text_lines(f"<article>{beside}{kept}</article>") == (True, ["a", "b", "c", "d"])
    assert [x for _, _, x in html_extract.all_lines("<nav>m</nav>t <button>b</button> u<script>s</script>")] == ["m", "t u", "b"]
    assert html_extract.text_lines('<p title="a > b">x</p><p title=">y</p>')[1][0] == "x"


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(9))] for _ in "ab")
        best = 0
        for mask in range(1 << len(a)):
            sub = [x for k, x in enumerate(a) if mask >> k & 1]
            it = iter(b)
            if all(x in it for x in sub):
                best = max(best, len(sub))
        got = html_extract.common_lines(a, b)
        it = iter(b)
        assert len(got) == best and got == sorted(set(got)) and all(a[k] in it for k in got)


def test_site_lines_go_and_articles_stay(spark):
    rows = [(k, f"https://h.example.com/en/{k:03}", f"<div>Site menu</div><p>story {k}</p><p>more {k}</p><div>Imprint</div>") for k in range(40)]
    rows += [(100 + k, f"https://h.example.com/en/{k:03}b", "<div>Site menu</div><p>twice</p><p>told</p><p>tale</p><p>it is</p><div>Imprint</div>") for k in range(2)]
    rows += [(200 + k, f"http://q.example.org/{k}", f"<article><h1>t{k}</h1><p>quoted</p><p>own {k}</p></article>") for k in range(3)]
    rows += [(300, None, None), (301, None, ""), (None, "x", "<p>alone</p>"), rows[5]]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("key", F.lit("clash"))
    out = html_extract.main_text(df)
    assert out.count() == len(rows)
    got = {r.page_id: r.text for r in out.collect()}
    assert all(got[k] == f"story {k}\nmore {k}" for k in range(40))
    assert got[100] == got[101] == "twice\ntold\ntale\nit is"
    assert got[201] == "t1\nquoted\nown 1"
    assert got[300] == got[301] == "" and got[None] == "alone"
    assert out.where("n_chars <> length(text)").count() == 0
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_template_goes_where_it_is_most_of_the_page(spark):
    menu, imprint = "".join(f"<div>menu {k}</div>" for k in range(6)), "".join(f"<div>imprint {k}</div>" for k in range(4))
    told = [f"told {k}" for k in range(5)]
    own = {k: [f"story {k} part {j}" for j in range(5)] for k in range(40)} | {40: told, 41: told, 42: [*told[:4], "edited"]}
    rows = [(k, f"https://h.example.com/{k % 40:03}", menu + "".join(f"<p>{x}</p>" for x in xs) + imprint) for k, xs in own.items()]
    rows += [(100 + k, f"https://few.example.com/{k}", menu + f"<p>short {k}</p>" + imprint) for k in range(5)]
    copy = [f"copy {k}" for k in range(10)]
    rows += [(200 + k, f"https://copies.example.com/{k}", "".join(f"<p>{x}</p>" for x in copy)) for k in range(9)]
    rows += [(300 + k, f"https://z.example.com/{k}", "".join(f"<p>{x}</p>" for x in [*copy[:9], f"edit {k}"])) for k in range(3)]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == "\n".join(xs) for k, xs in own.items())
    assert all(got[100 + k] == f"short {k}" for k in range(5))
    assert all(got[200 + k] == "\n".join(copy) for k in range(9))
    assert all(got[300 + k] == "\n".join([*copy[:9], f"edit {k}"]) for k in range(3))


def test_differencing_does_not_depend_on_blocks(spark, monkeypatch):
    rows = [(k, f"https://h.example.com/{k:03}", f"<p>menu</p><p>story {k}</p>" + "<p>often</p>" * (k % 3 == 0)) for k in range(90)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole = sorted(map(tuple, html_extract.main_text(df).collect()))
    monkeypatch.setattr(html_extract, "BLOCK", 32)
    assert sorted(map(tuple, html_extract.main_text(df).collect())) == whole


# sharding


def same(df):
    return sorted(map(str, df.collect()))


def test_compaction_keeps_every_row_and_every_version(spark, tmp_path):
    docs = documents(spark).withColumn("_arrival", F.lit("clash"))
    s = compaction.ShardSet(spark, f"file://{tmp_path}/s", target_bytes=64 << 10, smallest_bytes=1 << 10)
    assert s.version() == 0 and s.read().count() == 0
    for k in range(6):
        s.append(docs.where(F.coalesce(F.col("doc_id"), F.lit(0)) % 6 == k))
    assert s.append(docs.limit(0)) == 6
    assert s.version() == 6 and len(s.runs()) == 6
    before = {v: same(s.read(v)) for v in range(1, 7)}
    assert before[6] == same(docs)
    assert s.compact() > 6
    assert same(s.read()) == before[6]
    tiers = [s.tier(r) for r in s.runs() if not s.finished(r)]
    assert all(tiers.count(t) < s.fan_in for t in tiers)
    assert sum(r.rows for r in s.runs()) == docs.count() == sum(n for _, _, n, _ in s.shards())
    assert all(same(s.read(v)) == before[v] for v in before)  # merged, and still readable
    with pytest.raises(compaction.CommitConflict):
        s.commit(3, docs.schema, [])
    assert s.version() == s.compact()
    files = lambda: {str(f.relative_to(tmp_path / "s")) for f in (tmp_path / "s").glob("run-*/*.parquet")}
    (tmp_path / "s/run-crashed").mkdir()
    (tmp_path / "s/run-crashed/part-0.parquet").write_bytes(b"half")
    s.expire(keep=1)
    assert files() == {f for r in s.runs() for f in r.files} | {"run-crashed/part-0.parquet"} and s.versions() == [s.version()]
    assert same(s.read()) == before[6]
    s.expire(keep=1, orphan_seconds=-60)
    assert files() == {f for r in s.runs() for f in r.files} and same(s.read()) == before[6]
    assert s.compact(keep=1) == s.version() and empty(spark).count() == 0


def test_columns_that_arrive_later_stay(spark, tmp_path):
    s = compaction.ShardSet(spark, f"file://{tmp_path}/d", smallest_bytes=1 << 20)
    for k in range(3):
        s.append(spark.createDataFrame([(k, "x" * 5000)], "doc_id int, text string"))
    s.append(spark.createDataFrame([(1 << 40, "y", 7)], "doc_id bigint, text string, extra int"))
    rows = same(s.read())
    assert len(s.groups(s.runs())) == 1 and s.compact() == 5 and len(s.runs()) == 1
    assert same(s.read()) == rows and s.read().dtypes == [("doc_id", "bigint"), ("text", "string"), ("extra", "int")]
    assert {(r.doc_id, r.extra) for r in s.read().collect()} == {(0, None), (1, None), (2, None), (1 << 40, 7)}
    assert s.read(1).columns == ["doc_id", "text"]
    for bad in ("doc_id bigint, Text string", "doc_id bigint, text int"):
        with pytest.raises(ValueError):
            s.append(spark.createDataFrame([], bad))


def test_a_lost_race_keeps_both_writers_rows(spark, tmp_path):
    one, two = (compaction.ShardSet(spark, f"file://{tmp_path}/r", smallest_bytes=1 << 20) for _ in "ab")
    for k in range(4):
        one.append(spark.range(k, k + 1))
    merge = one._merge
    one._merge = lambda *a: (merge(*a), two.append(spark.range(100, 101)))[0]  # commits while the merge runs
    assert one.compact() == 6
    assert sorted(r.id for r in one.read().collect()) == [0, 1, 2, 3, 100] and len(one.runs()) == 2
    for k in range(3):
        two.append(spark.range(k, k + 1))
    one._merge = lambda *a: (merge(*a), two.compact())[0]  # merges the same runs first
    one.compact()
    assert sorted(r.id for r in one.read().collect()) == [0, 0, 1, 1, 2, 2, 3, 100]


def test_finished_shards_are_left_alone(spark, tmp_path):
    s = compaction.ShardSet(spark, f"file://{tmp_path}/f", target_bytes=2000, smallest_bytes=500)
    big = [compaction.Run(f"r{k}", 2000 * n, ("f",) * n, (2000,) * n, (1,) * n) for k, n in enumerate((1, 1, 4, 16, 1, 64))]
    assert s.groups(big) == []
    small = [compaction.Run(f"s{k}", 1900, ("f",) * 4, (475,) * 4, (1,) * 4) for k in range(9)]
    assert [len(g) for g in s.groups(big + small)] == [4, 4]


def test_sharding_query_equals_its_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = compaction.op7_sharding(spark, sf)
    want = c.execute(compaction.OP7_SQL).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def plain_main_text(rows):
    """Differencing of all pages of a host with their neighbours, written plainly. rows: page_id, url, html."""

    def lcs(a, b):
        best = {}
        for i in range(len(a), -1, -1):
            for j in range(len(b), -1, -1):
                if i == len(a) or j == len(b):
                    best[i, j] = []
                elif a[i] == b[j]:
                    best[i, j] = [i, *best[i + 1, j + 1]]
                else:
                    best[i, j] = max(best[i + 1, j], best[i, j + 1], key=len)
        return best[0, 0]

    hosts, out = {}, {}
    for k, url, html in set(rows):
        address = url.split("://", 1)[-1]
        host = address.split("/")[0]
        hosts.setdefault(host.lower(), []).append((address[len(host) :].split("?")[0].split("#")[0], k, html_extract.all_lines(html)))
    for pages in hosts.values():
        pages.sort()
        for i, (_, k, lines) in enumerate(pages):
            marked = any(r for r, kind, _ in lines if kind == html_extract.WANTED)
            best = max((r for r, kind, _ in lines if kind == html_extract.WANTED), default=0)
            near = [pages[j][2] for j in range(max(0, i - html_extract.NEIGHBOURS), min(len(pages), i + html_extract.NEIGHBOURS + 1)) if j != i]
            votes = [0] * len(lines)
            for other in near:
                for at in lcs([x for _, _, x in lines], [x for _, _, x in other]):
                    votes[at] += 1
            text, deleted = [], 0
            for (r, kind, x), n in zip(lines, votes, strict=True):
                inside = marked and r == best and kind == html_extract.WANTED
                need = max(3, len(near) / 2) if inside else 1 if marked else max(1, 0.15 * len(near))
                deleted += n >= need
                if n < need and kind == html_extract.WANTED and r == best:
                    text.append(x)
            out[k] = ("\n".join(text), deleted)
    return out


def test_main_text_equals_plain_differencing(spark, monkeypatch):
    """Boilerplate of every kind: marked up, unmarked, and inside the marked article."""
    rng = random.Random(10)
    rows = []
    for k in range(240):
        host = rng.choice(["a.example.com", "B.example.com", "c.example.org"])
        own = [f"<p>story {k} part {j}</p>" for j in range(rng.randint(3, 9))]
        if rng.random() < 0.5:  # one, so that the longest common subsequence is unique
            own[rng.randrange(len(own))] = f"<p>quote {rng.randrange(12)}</p>"
        menu = "".join(f"<div>menu {j}</div>" for j in range(rng.randint(1, 2)))
        if host == "a.example.com":  # nothing is marked
            html = menu + "".join(own) + f"<div>advert {rng.randrange(3)}</div><div>imprint</div>"
        elif host == "B.example.com":  # the site's lines stand inside the marked article
            html = f"<nav><li>m{k % 5}</li></nav><article><div>Share this</div>{''.join(own)}<div>Subscribe now</div></article><footer>{k}</footer>"
        else:
            html = f"<nav><li>the</li><li>and</li></nav><div class='ad'>buy {k % 9}</div><main>{''.join(own)}</main>"
        rows.append((k, f"http://{host}/{rng.randrange(60)}/{k}?x={k}", html))
    monkeypatch.setattr(html_extract, "BLOCK", 64)
    got = html_extract.main_text(spark.createDataFrame([*rows, rows[7]], "page_id bigint, url string, html string"))
    want = plain_main_text(rows)
    found = [(r.page_id, (r.text, r.n_deleted)) for r in got.collect()]
    assert len(found) == 241 and dict(found) == want
    texts = "\n".join(t for t, _ in want.values())
    assert not any(x in texts for x in ("menu", "imprint", "Share this", "Subscribe now", "buy"))
    assert sum(x.count("story") for x, _ in want.values()) == sum(h.count("story") for _, _, h in rows)


def test_html_query_has_a_row_for_each_page(spark, sf):
    out = html_extract.op10_html(spark, sf)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert out.columns[:4] == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.url) for r in out.collect()) == sorted((r.page_id, r.url) for r in pages.collect())
    assert out.where("n_deleted > 0").count() > 0  # most hosts of this small table have one page

"""Main text of pages that are built together with the text they should give: icons, frames, asides, comments, long pages."""

import html
import random
import tracemalloc

import pytest

from varaq.llm import html_extract as m


def built(rng):
    """A page and its article's lines, by construction: nothing of the operator is used."""
    n = iter(range(10_000))
    say = lambda kind: f"{kind} {next(n)} {rng.choice(['&', 'é', '<b', 'x  y', '😀'])}"
    show = lambda t: html.escape(t).replace("  ", rng.choice(["  ", "\n\t", " "]))
    icon = lambda: rng.choice(['<svg class="icon"/>', "<svg/>", '<svg viewBox="0"><path d="M0"/><title>icon</title></svg>', "<svg><g><text>icon</text></g></svg>", ""])
    lines, body = [], []
    for _ in range(rng.randint(1, 6)):
        t = say("text")
        lines.append(" ".join(t.split()))
        tag = rng.choice(["p", "h2", "blockquote", "li", "div"])
        body.append(f"{icon()}<{tag}>{icon()}{show(t)}{icon()}</{tag}>")
        extra = rng.randrange(8)
        if extra == 0:
            t = say("quote")
            lines.append(" ".join(t.split()))
            body.append(rng.choice(["<aside>", '<aside class="pullquote">']) + f"<p>{show(t)}</p></aside>")
        elif extra == 1:
            body.append(f"<article><p>{show(say('comment'))}</p><article><p>{show(say('answer'))}</p></article></article>")
        elif extra == 2:
            body.append(f'<form action="/s"><p>{show(say("sign up"))}</p><label>mail</label><input><button>go</button></form>')
        elif extra == 3:
            body.append(f'<aside class="related-posts"><p>{show(say("related"))}</p></aside>')
    page = f"<header><p>{show(say('site'))}</p></header><nav><ul><li>{icon()}<a>menu</a></li></ul></nav><article>{''.join(body)}</article><footer>{show(say('foot'))}</footer>"
    if rng.random() < 0.4:  # the whole page is one form
        page = f'<form id="aspnetForm" method="post"><div>{page}</div></form>'
    return f"<html><head><title>t</title></head><body>{page}</body></html>", lines


@pytest.mark.parametrize("seed", range(3))
def test_built_pages(seed):
    rng = random.Random(seed)
    for _ in range(100):
        page, want = built(rng)
        marked, got = m.text_lines(page)
        assert marked and got == want, page


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><p>one</p><svg class="icon"/><p>two</p></article>', ["one", "two"]),
        ("<article><p>one</p><svg><path><p>two</p></article><p>beside</p>", ["one", "two"]),  # an icon left open ends with a block
        ("<form><h1>t</h1><p>a</p></form>", ["t", "a"]),
        ("<form><p>a</p><p>b</p><p>c</p></form>", ["a", "b", "c"]),
        ("<p>x</p><form><p>mail?</p><p>now</p></form>", ["x"]),
        ('<form role="search"><h1>find</h1></form><p>x</p>', ["x"]),  # it says what it is
        ("<article><p>a</p><aside role=complementary>s</aside></article>", ["a"]),
        ("<aside><p>s</p></aside><p>a</p>", ["a"]),
        ("<main><article><p>a</p></article><article><p>b</p></article></main>", ["a", "b"]),  # beside one another
        ("<article/><p>a", ["a"]),
        ("", []),
    ],
)
def test_cases(page, want):
    assert m.text_lines(page)[1] == want


def test_alignment_of_long_pages_in_little_memory(monkeypatch):
    rng = random.Random(1)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for k, y in enumerate(b):
                row.append(last[k] + 1 if x == y else max(last[k + 1], row[k]))
        return row[-1]

    for cells in (1, 20, 400):
        monkeypatch.setattr(m, "TABLE_CELLS", cells)
        for _ in range(60):
            a, b = ([rng.randrange(6) for _ in range(rng.randrange(40))] for _ in range(2))
            got = m.aligned(a, b)
            assert len(got) == longest(a, b) and all(a[p] == b[q] for p, q in got)
            assert all(u[0] < v[0] and u[1] < v[1] for u, v in zip(got, got[1:], strict=False))
    monkeypatch.undo()
    a, b = ([rng.randrange(3000) for _ in range(6000)] for _ in range(2))
    tracemalloc.start()
    got = m.aligned(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got and most < 50e6  # a table of all lengths would take over 280 MB

"""Main text of web pages by nearest-URL page differencing (operator 10).

1. Each page's html becomes text lines, one for each block of its whole body: menus, footers and adverts too. Only what
   is never running text (scripts, styles, hidden parts, form fields) gives no line.
2. Within a host, pages are put in the order of their URL paths. Each page is paired with the NEIGHBOURS nearest on
   either side and their lines are aligned by longest common subsequence. Lines of the alignment are shared: the
   site's own text, not the article's. A pair most of whose article lines agree is either the same article twice or two
   pages of one template. Lines that TEMPLATE_SHARE of the different neighbours have, and TEMPLATE_PAGES at least, are
   the template's; if most of the other lines agree as well, it is the same article, and the pair has no say on them.
3. A line that enough pairs share is deleted: on a page that marks no article, SHARE of them and one at least; beside a
   marked article, one; inside it, where articles may quote each other, ARTICLE_SHARE of them and ARTICLE_VOTES at least.
4. Of the lines left, those go that the markup itself says are not the article: outside of the marked article (or else
   main element), or in elements, roles or names for menus, headers, footers, sidebars, notices, adverts, forms and
   comments. A class or id counts only if all its words are about such things: "related-posts", not "related-work". A form
   that holds the article, a main part, a first heading or several paragraphs is the page's frame and no form; an aside
   inside the article is part of it, unless its names say otherwise; an article inside the article is a comment.

Alignments of long pages are found by halving, in memory that grows with their lengths; their time grows with the product.

Pages are parsed twice, for the hashes and for the texts: texts that wait on disk for the deletions cost more disk than
a second pass costs time (README). Positions in a host come from a range partitioning and partition sums, so one large
host is spread over all tasks; blocks of BLOCK pages, with the neighbours at their edges, are differenced on line hashes
alone.

Defined results: a null html is empty; a null url belongs to the host and path ""; rows that repeat another in all
three columns count once for differencing and get the same text; texts are handled whole, whatever their length; further
columns, also such with names used here, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.llm.common import in_small_batches, materialise, table

NEIGHBOURS = 16
SHARE = 0.15
ARTICLE_SHARE = 0.5
ARTICLE_VOTES = 3
#: Share of the shorter page's lines from which on two pages are the same article.
SAME_ARTICLE = 0.6
#: Share and number of different neighbours from which on a line of theirs is the template's, whatever else they share.
TEMPLATE_SHARE = 0.5
TEMPLATE_PAGES = 3
BLOCK = 256
#: Pages that one task puts in order, about.
ORDERED = 200_000

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without any running text, and elements whose text is not the article's.
_SILENT = frozenset("audio canvas datalist embed head iframe input map noscript object option script select style svg template textarea title video".split())
_BESIDE = frozenset("aside button dialog fieldset footer form menu nav".split())
#: Elements in foreign content, and how many paragraphs make a form the frame of a page.
_FOREIGN = frozenset(("svg", "math"))
FRAME_PARAGRAPHS = 3
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar".split())
#: Words of class and id names for what is not the article, and words that may stand beside them.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer footers gdpr menu menus modal nav navbar navigation newsletter notice notices pager pagination popup popups promo promos promoted promotion "
    "related replies reply respond share shares sharing sidebar sidebars social sponsor sponsored sponsors subscribe subscription teaser teasers toolbar "
    "widget widgets".split()
)
_NEUTRAL = frozenset(
    "a all and area article articles bar block blocks body bottom box boxes button buttons buy call card cards col column container content cta desktop entry "
    "first footer form global group head header holder home icon icons id inline inner item items js label last layer layout left link links list lists main "
    "media mobile module more network networks news of outer overlay page pages panel post posts primary reader readers right row secondary section sections "
    "signup site slot sticky stories story strip text the this thread title top topics unit user users view wrap wrapper".split()
)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", re.S)
_RAW = re.compile(r"<(script|style|noscript|template|textarea|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"""(<[!?][^>]*>|</?[a-zA-Z](?>[^>"']|"[^"]*"|'[^']*'|["'])*(?:>|\Z))""")
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
_HIDDEN = re.compile(r"\shidden(?=[\s>=/])|display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: What an element is: WANTED, BESIDE the article, or SILENT.
WANTED, BESIDE, SILENT = 0, 1, 2


def names_other_than_article(value: str) -> bool:
    """Whether a class or id says that an element is not the article: of one of its names, all words do or are neutral."""
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if any(w in _NAMES for w in words) and all(w in _NAMES or w in _NEUTRAL or w.isdigit() for w in words):
            return True
    return False


def _says(tag: str, names: bool = True) -> bool:
    """Whether an element's attributes say that it is not the article."""
    for key, value in _ATTRIBUTE.findall(tag):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id") and names and names_other_than_article(value) or key == "role" and value.lower() in _ROLES:
            return True
    return False


def _kind(name: str, tag: str) -> int:
    if name in _SILENT:
        return SILENT
    kind = BESIDE if name in _BESIDE else WANTED
    if len(tag) == len(name) + 2:
        return kind
    if _HIDDEN.search(tag):
        return SILENT
    return BESIDE if _says(tag, name not in ("html", "body", "main")) else kind


def _frames(tokens: list[str]) -> set[int]:
    """Places of the forms that hold the page rather than questions to its reader: those with an article, a main part, a
    first heading or several paragraphs."""
    out: set[int] = set()
    open_, paragraphs = None, 0
    for k in range(1, len(tokens), 2):
        found = _NAME.match(tokens[k])
        name = found[1].lower() if found else ""
        if name == "form":
            open_, paragraphs = (None if tokens[k][1] == "/" else k), 0
        elif open_ is not None and tokens[k][1] != "/":
            paragraphs += name == "p"
            if name in ("article", "main", "h1") or paragraphs >= FRAME_PARAGRAPHS:
                out.add(open_)
                open_ = None
    return out


def all_lines(html: str) -> list[tuple[int, int, str]]:
    """The page's text blocks in order, each on one line: rank of the container (2 in an article, 1 in main, 0 else),
    kind (WANTED or BESIDE), text."""
    html = _RAW.sub(" ", _COMMENT.sub("", html))
    lines: list[tuple[int, int, str]] = []
    parts: tuple[list[str], list[str]] = [], []  # of the open block, by kind: an inline button does not end it
    stack: list[tuple[str, int, int]] = []  # name, kind, rank
    kind, rank = WANTED, 0

    def close() -> None:
        for own in (WANTED, BESIDE):
            if parts[own]:
                text = " ".join(entities.unescape("".join(parts[own])).split())
                if text:
                    lines.append((rank, own, text))
                parts[own].clear()

    tokens = _TAG.split(html)
    frames = _frames(tokens) if "<form" in html or "<FORM" in html or "<Form" in html else ()
    for k, token in enumerate(tokens):
        if k % 2 == 0:
            if token and kind != SILENT:
                parts[kind].append(token)
            continue
        found = _NAME.match(token)
        if found is None:
            continue
        name = found[1].lower()
        block = name in _BLOCKS
        if block and kind == SILENT and any(x[0] in _FOREIGN for x in stack):  # a block ends an icon that was left open
            del stack[next(at for at, x in enumerate(stack) if x[0] in _FOREIGN) :]
            kind, rank = (stack[-1][1], stack[-1][2]) if stack else (WANTED, 0)
        if block and kind != SILENT:
            close()
        elif name == "br" and kind != SILENT:
            parts[kind].append(" ")
        if token[1] == "/":
            if any(x[0] == name for x in stack):
                while stack.pop()[0] != name:
                    pass
                kind, rank = (stack[-1][1], stack[-1][2]) if stack else (WANTED, 0)
            continue
        if name in _VOID or token.endswith("/>"):
            continue
        if block:  # an open paragraph ends where a block begins
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "p" or name == "li" == stack[at][0]:
                    del stack[at:]
                    kind, rank = (stack[-1][1], stack[-1][2]) if stack else (WANTED, 0)
                    break
                if stack[at][0] in _BLOCKS:
                    break
        if kind != SILENT:
            own = _kind(name, token)
            if own == BESIDE and (k in frames or name == "aside" and rank == 2) and not _says(token):
                own = WANTED  # the frame of the page, or a quotation set into the article
            if name == "article" and rank == 2:
                own = max(own, BESIDE)  # an article inside an article is a reader's comment
            if max(kind, own) == WANTED and name in ("article", "main"):
                rank = max(rank, 2 if name == "article" else 1)
            kind = max(kind, own, BESIDE if name == "header" and not rank else WANTED)
        stack.append((name, kind, rank))
    if kind != SILENT:
        close()
    return lines


def text_lines(html: str) -> tuple[bool, list[str]]:
    """Whether the page marks its article or main part, and the lines that its own markup leaves."""
    lines = all_lines(html)
    best = max((r for r, kind, _ in lines if kind == WANTED), default=0)
    return best > 0, [text for r, kind, text in lines if kind == WANTED and r == best]


def _key(row: tuple) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(repr(row).encode())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Batches of bounded size, and for each row its key (a digest of the whole row), lines, and places of the lines
    that the markup leaves."""
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                lines = all_lines(row[2] or "")
                best = max((r for r, kind, _ in lines if kind == WANTED), default=0)
                out.append((_key(row), lines, best > 0, [k for k, (r, kind, _) in enumerate(lines) if kind == WANTED and r == best]))
            yield batch, out


HASHED = "key binary, url string, hashes array<bigint>, inside array<boolean>"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hashes: of every line; inside: whether it is in the marked article."""
    from xxhash import xxh3_64_intdigest

    for batch, rows in _rows(batches):
        hashes, inside = [], []
        for _, lines, marked, left in rows:
            hashes.append([xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63) for _, _, text in lines])
            own = set(left) if marked else ()
            inside.append([k in own for k in range(len(lines))])
        key = pa.array([x[0] for x in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([key, batch.column("url"), pa.array(hashes, pa.list_(pa.int64())), pa.array(inside, pa.list_(pa.bool_()))], names=["key", "url", "hashes", "inside"])


PACKED = "key binary, page_id bigint, url string, n int, at array<int>, packed binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n: number of lines; at: places of those that the markup leaves; packed: their texts, compressed for the shuffle."""
    from zstandard import ZstdCompressor

    pack = ZstdCompressor(level=3).compress
    for batch, rows in _rows(batches):
        packed = [pack("\n".join(lines[k][2] for k in left).encode("utf-8", "replace")) for _, lines, _, left in rows]
        key, n, at = pa.array([x[0] for x in rows], pa.binary()), pa.array([len(x[1]) for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([key, batch.column("page_id"), batch.column("url"), n, at, pa.array(packed, pa.binary())], names=["key", "page_id", "url", "n", "at", "packed"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that neither differencing nor the markup has deleted."""
    from zstandard import ZstdDecompressor

    unpack = ZstdDecompressor().decompress
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            texts, by_markup = [], []
            for packed, at, n, dropped in zip(*(batch.column(c).to_pylist() for c in ("packed", "at", "n", "dropped")), strict=True):
                gone = set(dropped or ())
                lines = unpack(packed).decode().split("\n") if at else []
                texts.append("\n".join(x for k, x in zip(at, lines, strict=True) if k not in gone))
                by_markup.append(n - len(gone.union(at)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pc.fill_null(pc.list_value_length(batch.column("dropped")), 0).cast(pa.int64()), pa.array(by_markup, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_deleted", "n_by_markup"],
            )


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places in a and in b of a longest common subsequence."""
    out = []
    i, j, x, y = 0, 0, len(a), len(b)
    while i < x and j < y and a[i] == b[j]:  # what both begin and end with is in one
        out.append((i, j))
        i, j = i + 1, j + 1
    tail = []
    while x > i and y > j and a[x - 1] == b[y - 1]:
        x, y = x - 1, y - 1
        tail.append((x, y))
    both = set(a[i:x]) & set(b[j:y])
    if both:
        at = [k for k in range(i, x) if a[k] in both]
        other = [k for k in range(j, y) if b[k] in both]
        number = {h: n for n, h in enumerate(both)}
        middle = _lcs([number[a[k]] for k in at], [number[b[k]] for k in other])
        out += [(at[p], other[q]) for p, q in middle]
    return out + tail[::-1]


#: Cells up to which a table of all lengths is kept; longer pairs are halved until they are as small.
TABLE_CELLS = 40_000


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of a and each beginning of b: one row at a time."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def _by_table(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    rows = [[0] * (len(b) + 1)]
    for x in a:
        last, row = rows[-1], [0]
        for n, y in enumerate(b):
            row.append(last[n] + 1 if x == y else max(last[n + 1], row[n]))
        rows.append(row)
    out, p, q = [], len(a), len(b)
    while p and q:
        if a[p - 1] == b[q - 1]:
            p, q = p - 1, q - 1
            out.append((p, q))
        elif rows[p - 1][q] >= rows[p][q - 1]:
            p -= 1
        else:
            q -= 1
    return out[::-1]


def _lcs(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in memory that grows with the lengths (Hirschberg's halving)."""
    out, parts = [], [(0, len(a), 0, len(b))]
    x, y = np.array(a, np.int64), np.array(b, np.int64)
    while parts:
        i, k, j, m = parts.pop()
        if (k - i) * (m - j) <= TABLE_CELLS or k - i == 1:
            out += [(i + p, j + q) for p, q in _by_table(a[i:k], b[j:m])]
            continue
        half = (i + k) // 2
        cut = j + int(np.argmax(_lengths(x[i:half], y[j:m]) + _lengths(x[half:k][::-1], y[j:m][::-1])[::-1]))
        parts += [(half, k, cut, m), (i, half, j, cut)]  # the first half is taken next
    return out


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in a of a longest common subsequence of a and b."""
    return [k for k, _ in aligned(a, b)]


def _template(page: list[int], around: list[list[int]]) -> set[int]:
    """Lines of page that many of the pages around have; equal pages count once, those equal to page not at all."""
    others = {tuple(x) for x in around} - {tuple(page)}
    least = max(TEMPLATE_PAGES, TEMPLATE_SHARE * len(others))
    number: dict[int, int] = {}
    for x in others:
        for h in set(x):
            number[h] = number.get(h, 0) + 1
    return {h for h in page if number.get(h, 0) >= least}


def _difference(rows: pd.DataFrame) -> pd.DataFrame:
    """key and the places of deleted lines, for the block's own pages."""
    rows = rows.sort_values("rank", kind="stable")
    lines = [list(map(int, h)) for h in rows["hashes"]]
    inside = [list(map(bool, x)) for x in rows["inside"]]
    keys, own, n = rows["key"].tolist(), rows["own"].tolist(), len(rows)
    marked = [any(x) for x in inside]
    core = [[h for h, x in zip(hs, xs, strict=True) if x] if m else hs for hs, xs, m in zip(lines, inside, marked, strict=True)]
    votes = [np.zeros(len(x), dtype=np.int32) for x in lines]
    pairs = [0] * n
    often: dict[int, int] = {}
    for x in lines:
        for h in set(x):
            often[h] = often.get(h, 0) + 1
    places = [[k for k, h in enumerate(x) if often[h] > 1] for x in lines]  # a line that one page has is never shared
    seen = [tuple(x[k] for k in at) for x, at in zip(lines, places, strict=True)]
    template: dict[int, set[int]] = {}
    known: dict[tuple, list[tuple[int, int]]] = {}

    def vote(i: int, j: int, shared: list[int], alike: bool) -> None:
        """What the pair says on lines of page i; shared: their places."""
        if alike:
            if i not in template:
                template[i] = _template(core[i], core[max(0, i - NEIGHBOURS) : i] + core[i + 1 : i + NEIGHBOURS + 1])
            site, line = template[i], lines[i]
            rest = [k for k in shared if line[k] not in site and (inside[i][k] or not marked[i])]
            if rest and (not site or len(rest) >= SAME_ARTICLE * min(sum(h not in site for h in core[x]) for x in (i, j))):
                no_say = set(rest)
                shared = [k for k in shared if k not in no_say]
        votes[i][shared] += 1

    for i in range(n):
        for j in range(i + 1, min(n, i + NEIGHBOURS + 1)):
            pairs[i] += 1
            pairs[j] += 1
            if not seen[i] or not seen[j]:
                continue
            both = known.get((seen[i], seen[j]))  # menus come in few kinds
            if both is None:
                if len(known) > 20_000:
                    known.clear()
                both = known[seen[i], seen[j]] = aligned(seen[i], seen[j])
            if not both:
                continue
            mine, theirs = [places[i][a] for a, _ in both], [places[j][b] for _, b in both]
            least = min(len(core[i]), len(core[j]))
            agree = [sum(inside[x][k] for k in at) if marked[x] else len(at) for x, at in ((i, mine), (j, theirs))]
            alike = min(agree) > 1 and min(agree) >= SAME_ARTICLE * least
            vote(i, j, mine, alike)
            vote(j, i, theirs, alike)
    out = []
    for k in range(n):
        if not own[k]:
            continue
        if marked[k]:
            needed = np.where(inside[k], max(ARTICLE_VOTES, ARTICLE_SHARE * pairs[k]), 1)
        else:
            needed = max(1, SHARE * pairs[k])
        gone = np.flatnonzero(votes[k] >= needed).tolist()
        if gone:
            out.append((keys[k], gone))
    return pd.DataFrame({"key": pd.Series([x[0] for x in out], dtype="object"), "dropped": pd.Series([x[1] for x in out], dtype="object")})


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_deleted (lines that differencing deleted) and n_by_markup (further lines that only
    the markup says are not the article) for each row of pages."""
    spark = pages.sparkSession
    rows = in_small_batches(pages).select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parsed = materialise(rows.mapInArrow(_hashed, HASHED), "parsed")
    address = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    path = F.regexp_replace(address, r"^[^/?#]*", "")
    light = parsed.select("key", F.lower(F.regexp_extract(address, r"^[^/?#]*", 0)).alias("host"), F.split(path, r"[?#]", 2)[0].alias("path"), "hashes", "inside")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), parsed.count() // ORDERED)
    light = light.dropDuplicates(["key"]).repartitionByRange(parts, "host", "path", "key").sortWithinPartitions("host", "path", "key")
    placed = materialise(light.withColumn("at", F.monotonically_increasing_id()), "lines")  # partition and place in it
    part = F.shiftright("at", 33)
    sums = placed.groupBy("host", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("host").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (
        placed.withColumn("part", part)
        .join(sums.select("host", "part", "first", before.alias("before")), ["host", "part"])
        .withColumn("rank", F.col("before") + F.col("at") - F.col("first"))
        .withColumn("home", F.expr(f"rank div {BLOCK}"))
    )
    place = F.col("rank") % BLOCK
    around = ranked.withColumn(
        "block",
        F.explode(
            F.array_compact(
                F.array(
                    F.col("home"),
                    F.when((place < NEIGHBOURS) & (F.col("home") > 0), F.col("home") - 1),
                    F.when(place >= BLOCK - NEIGHBOURS, F.col("home") + 1),
                )
            )
        ),
    )
    dropped = (
        around.select("host", "block", "rank", "key", "hashes", "inside", (F.col("block") == F.col("home")).alias("own"))
        .groupBy("host", "block")
        .applyInPandas(_difference, "key binary, dropped array<int>")
    )
    left = rows.mapInArrow(_packed, PACKED).join(dropped, "key", "left").drop("key")
    return left.mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint, n_deleted bigint, n_by_markup bigint")


def op10_html(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))

"""Secret scan by corpus-wide ownership (operator 11).

Base spans (assignments, access keys, long hexadecimal numbers) are found by patterns. Beside them, every run of 20 or
more characters of base64 or of a path that holds letters, digits and LEAST_DISTINCT different characters is a
candidate, unless it touches a base span. Only digests of values travel: they are counted over the corpus by distinct
repositories and owners. A value that COPIED_OWNERS owners or more have is a widely copied example; one that looks live,
of a single owner and in at most LIVE_REPOS of the owner's repositories, is that owner's credential. Candidates of the second
sort become spans of kind `live`; base spans stay, whatever their verdict, and n_live and n_copied count the verdicts of
both.

A digest is counted in steps (rows of a repository, repositories of an owner, owners), each with partial sums, so that a
value that stands everywhere is a few rows after the first. On the way back to the texts, values with over a thousandth of
all occurrences, fewer than a thousand by that rule, are broadcast; the others are joined by digest.

Defined results: a null text is empty, a null owner or repository part is ''; each input row gives one row, repeated ones and
those without a doc_id too; without spans the digest is that of no bytes; of spans that begin together the order is that
of KINDS; further columns are not read. Texts are read whole, in time that grows with their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varaq.llm.common import chunks, in_small_batches, materialise, table, text_or_empty

#: Span kinds in the order of the contract; the last one is what the method adds.
KINDS = ("assign", "access", "hex", "live")
LEAST_DISTINCT = 10
COPIED_OWNERS = 3
LIVE_REPOS = 3
#: A value with more than this share of all occurrences is joined by broadcast.
HOT_SHARE = 0.001

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
# a run can begin only where the one before has ended, so that each is read once
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

_FOUND = "array<struct<start:int,k:int,end:int,looks:boolean,hash:binary>>"
_FOUND_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("k", pa.int32()), ("end", pa.int32()), ("looks", pa.bool_()), ("hash", pa.binary())]))


def looks_live(value: str) -> bool:
    return bool(_DIGIT.search(value) and _LETTER.search(value)) and len(set(value)) >= LEAST_DISTINCT


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place in KINDS, end, value) by start and kind: base spans, and runs that look live beside them. Values are
    told apart without the padding at their end."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    found.sort()
    base, k, end, out = found, 0, 0, list(found)
    for m in _RUN.finditer(text):
        while k < len(base) and base[k][0] < m.end():  # spans of different kinds may overlap, so the furthest end counts
            end = max(end, base[k][2])
            k += 1
        if m.start() >= end and looks_live(m.group().rstrip("=")):
            out.append((m.start(), 3, m.end(), m.group()))
    return sorted((start, k, end, value.rstrip("=")) for start, k, end, value in out)


def with_candidates(docs: DataFrame) -> DataFrame:
    """doc_id, owner, repo, found (as of candidates(), with digests in place of values). docs: doc_id, text, owner, repo."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                rows = [[{"start": s, "k": k, "end": e, "looks": looks_live(v), "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).digest()[:16]} for s, k, e, v in candidates(text)] for text in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), part.column("owner"), part.column("repo"), pa.array(rows, _FOUND_TYPE)], ["doc_id", "owner", "repo", "found"])

    return in_small_batches(docs).select("doc_id", "text", "owner", "repo").mapInArrow(run, f"doc_id bigint, owner string, repo string, found {_FOUND}")


def ownership(seen: DataFrame) -> DataFrame:
    """hash, n_rows, n_repos, n_owners. seen: hash, owner, repo of each occurrence; a repository is one of its owner."""
    n = F.count("*").alias("n_rows")
    repos = seen.groupBy("hash", "owner", "repo").agg(n)
    owners = repos.groupBy("hash", "owner").agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_repos"))
    return owners.groupBy("hash").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_repos").alias("n_repos"), F.count("*").alias("n_owners"))


def scan(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """doc_id, found (base spans and candidates), live and copied (their places in found that the corpus calls so), for each
    row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), F.coalesce(repo.cast("string"), F.lit("")).alias("repo"))
    rows = materialise(with_candidates(docs).withColumn("_row", F.monotonically_increasing_id()), "candidates")  # row numbers are fixed from here on
    seen = rows.select("_row", "owner", "repo", F.posexplode("found").alias("at", "c")).select("_row", "owner", "repo", "at", "c.looks", "c.hash")
    owned = materialise(ownership(seen), "ownership")
    total = owned.agg(F.sum("n_rows")).first()[0] or 0
    copied = F.col("n_owners") >= COPIED_OWNERS
    single = (F.col("n_owners") == 1) & (F.col("n_repos") <= LIVE_REPOS)
    told = owned.where(copied | single).select("hash", copied.alias("copied"), (F.col("n_rows") > HOT_SHARE * total).alias("hot"))
    hot = told.where("hot").drop("hot")  # fewer than 1 / HOT_SHARE rows
    slim = seen.select("_row", "at", "looks", "hash").join(F.broadcast(hot), "hash", "left")
    common = slim.where("copied is not null")
    rest = slim.where("copied is null").drop("copied").join(told.where("not hot").drop("hot"), "hash")
    verdicts = common.unionByName(rest).where("copied or looks")
    by_row = verdicts.groupBy("_row").agg(F.collect_list(F.when(~F.col("copied"), F.col("at"))).alias("live"), F.collect_list(F.when(F.col("copied"), F.col("at"))).alias("copied"))  # bounded by the text
    none = F.array().cast("array<int>")
    out = rows.select("doc_id", "found", "_row").join(by_row, "_row", "left")
    return out.select("doc_id", "found", *(F.coalesce(c, none).alias(c) for c in ("live", "copied")))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.get(names, s["k"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    """Sources are the owners, a source's documents of one language one of its repositories."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), F.col("source"), F.col("lang"))
    base = F.filter("found", lambda s: s["k"] < 3)
    stay = F.filter("found", lambda s, i: (s["k"] < 3) | F.array_contains("live", i))
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(found, s -> s.k = {k})) as bigint)").alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(stay).alias("spans"),
        F.size("live").cast("bigint").alias("n_live"),
        F.size("copied").cast("bigint").alias("n_copied"),
    )


def _sql() -> str:
    """SQL spelt from the contract and the rule above: matches and what stands between them give the places."""
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    patterns = {
        "assign": rf"""({names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
        "live": r"[A-Za-z0-9+/_-]+={0,2}",
    }
    found = " UNION ALL ".join(f"SELECT r, owner, repo, {k} AS k, regexp_extract_all(t, '{x}') AS m, string_split_regex(t, '{x}') AS g FROM d" for k, x in enumerate(patterns.values()))
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner, coalesce(lang, '') AS repo FROM documents), found AS ({found}), placed AS (
      SELECT r, owner, repo, k, m, list_transform(m, lambda x: length(x)) AS lm, list_transform(g, lambda x: length(x)) AS lg FROM found WHERE len(m) > 0
    ), one AS (
      SELECT r, owner, repo, k, unnest(m) AS x, unnest(lm) AS n, unnest(lg[1 : len(m)]) AS gap, unnest(range(1, len(m) + 1)) AS i FROM placed
    ), sited AS (
      SELECT r, owner, repo, k, x, (sum(gap + n) OVER (PARTITION BY r, k ORDER BY i) - n)::BIGINT AS start, CASE WHEN k = 0 THEN regexp_extract(x, '{patterns["assign"]}', 2) ELSE x END AS whole, rtrim(whole, '=') AS value FROM one
    ), looked AS (
      SELECT *, start + length(x) AS stop, regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= {LEAST_DISTINCT} AS looks
      FROM sited WHERE length(whole) >= CASE k WHEN 0 THEN 8 WHEN 1 THEN 16 WHEN 2 THEN 32 ELSE 20 END AND (k < 3 OR length(value) >= 20)
    ), span AS (
      SELECT * FROM looked WHERE k < 3
      UNION ALL SELECT * FROM looked a WHERE k = 3 AND looks AND NOT EXISTS (SELECT 1 FROM looked b WHERE b.k < 3 AND b.r = a.r AND b.start < a.stop AND a.start < b.stop)
    ), owned AS (
      SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repo)) AS n_repos FROM span GROUP BY value
    ), told AS (
      SELECT *, n_owners >= {COPIED_OWNERS} AS copied, looks AND n_owners = 1 AND n_repos <= {LIVE_REPOS} AS live, ['assign', 'access', 'hex', 'live'][k + 1] || ':' || start || ':' || stop AS said FROM span JOIN owned USING (value)
    ), listed AS (
      SELECT r, {", ".join(f"count(*) FILTER (k = {k}) AS n_{KINDS[k]}" for k in range(3))}, string_agg(said, ',' ORDER BY start, k) FILTER (k < 3) AS base,
        string_agg(said, ',' ORDER BY start, k) FILTER (k < 3 OR live) AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied FROM told GROUP BY r
    )
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS[:3])}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
    FROM d LEFT JOIN listed USING (r)
    """


OP11_SQL = _sql()

"""PII by information-theoretic sanitisation (operator 4), in DataFrame and SQL functions only.

Base spans (e-mail, IP, card, phone) are found by patterns and checks. Over all documents, the pointwise mutual
information of each protected value with each term of its documents is divided by the value's information content:

    disclosure = log(P(value | term) / P(value)) / log(1 / P(value))

in documents; 1 means that the term alone gives the value away. Small counts weigh less: P(value | term) is the lower
end of its one-sided Wilson interval (CONFIDENCE), and must be TOLD at least, whatever the number of documents. Documents
in which a value stands in the same words on either side (WINDOW) are copies and count as one witness. Values that stand
in the same documents are one entity and are rated together.

A term must also stand beside the entity more often than chance explains. One witness is no evidence: every word of a
document is in it. From LEAST_WITNESSES on, the tail of the Poisson distribution with the mean that independence gives is
bounded by Chernoff, which is 2 to the power of minus the pair's divergence in bits; the bits that count are chosen by
the step-up rule of Benjamini and Hochberg over all pairs of an entity and a term that could have so many witnesses, with
FALSE_DISCOVERIES. Terms that pass are generalised from GENERALISE on and removed from REMOVE on, wherever they stand in
the documents of that value. Base spans always stay; words that touch one are no terms there.

Patterns are written so that each run of characters is read once (possessive, with \\G where a match may begin
inside a run): same matches as the plain patterns, without their quadratic time on long runs.

Defined results: a null text counts as empty and stays null when sanitised; each input row gives one row; without
spans the digest is that of no bytes; columns of the input that clash with names used here are kept apart; repeated rows are
copies, so one witness; spans that begin at one place go by kind; very long texts are read whole, once for each pattern;
an empty table gives an empty result; a word beside U+FFFF, which is no character, is no term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.llm.common import materialise, table

#: Span kinds in the order of the contract; then those that the method adds.
KINDS = ("email", "ip", "card", "phone", "term", "cue")
BASE_KINDS = 4
REPLACED_BY = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]", "")
#: Code points on each side of a value that tell copies.
WINDOW = 160
#: Standard deviations of the lower bound: 95 % on one side.
CONFIDENCE = 1.645
GENERALISE = 0.8
REMOVE = 0.95
#: The least lower bound of P(value | term) of a term that gives a value away.
TOLD = 0.1
#: Witnesses that a pair needs, and the share of false ones among the pairs that pass the test against chance.
LEAST_WITNESSES = 2
FALSE_DISCOVERIES = 0.05
#: Bits of evidence are counted up to this many.
MOST_BITS = 1000
#: Terms in more than this share of the documents are sent to all tasks, as far as they can give no value away and are
#: at most so many.
FREQUENT = 0.001
BROADCAST_TERMS = 200_000

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TERM = r"[\p{L}\p{N}]+"
#: Stands for each character of a base span while terms are looked for.
HIDDEN = "\uffff"

_SPAN = "struct<start:int,k:int,end:int,value:string>"


def _starts(found: str, gaps: str) -> str:
    """SQL for the start offsets of matches, given what stands between them."""
    return f"""aggregate(sequence(0, size({found}) - 1),
      named_struct('p', 0, 's', cast(array() as array<int>)),
      (a, i) -> named_struct('p', a.p + length({gaps}[i]) + length({found}[i]), 's', concat(a.s, array(a.p + length({gaps}[i])))),
      a -> a.s)"""


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


#: Of the digits d: doubled ones add their digit sum.
_LUHN = """aggregate(sequence(1, length(d)), 0, (s, i) -> s + exists_digit) % 10 = 0""".replace(
    "exists_digit", "element_at(if(i % 2 = 1, array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9), array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)), 1 + cast(substring(d, length(d) - i + 1, 1) as int))"
)

_VALID = (
    "true",
    "forall(split(x, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(right(p, 3) as int), 0) <= 255)",
    f"exists(array({_digits('x')}), d -> length(d) between 14 and 19 and {_LUHN})",
    f"length({_digits('x')}) between 10 and 15",
)


def _spans_of(df: DataFrame, text: str, k: int, pattern: str, guard: Column) -> DataFrame:
    """Adds _s<k>: the valid spans of one kind."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(guard, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    df = df.withColumn("_b", F.when(F.size("_m") > 0, F.expr(_starts("_m", "_g"))).otherwise(F.array().cast("array<int>")))
    made = f"transform(_m, (x, i) -> named_struct('start', _b[i], 'k', {k}, 'end', _b[i] + length(x), 'value', x))"
    spans = F.when(F.size("_m") > 0, F.expr(f"filter({made}, s -> exists(array(s.value), x -> {_VALID[k]}))"))
    return df.withColumn(f"_s{k}", F.coalesce(spans.cast(f"array<{_SPAN}>"), F.array().cast(f"array<{_SPAN}>"))).drop("_m", "_g", "_b")


def with_base_spans(docs: DataFrame, text: str, into: str) -> DataFrame:
    """docs with the base spans (start, k: place in KINDS, end, value) of the column `text`, by start and kind."""
    df = docs.withColumn("_t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    digits = F.col("_t").rlike("[0-9]")
    df = df.withColumn("_digits", digits)
    df = _spans_of(df, "_t", 0, EMAIL, F.col("_t").contains("@"))
    df = _spans_of(df, "_t", 1, IP, F.col("_digits"))
    df = _spans_of(df, "_t", 2, CARD, F.col("_digits"))
    df = _spans_of(df, "_t", 3, PHONE, F.col("_digits") & F.col("_t").contains("+"))
    return df.withColumn(into, F.array_sort(F.concat("_s0", "_s1", "_s2", "_s3"))).drop("_t", "_digits", "_s0", "_s1", "_s2", "_s3")


def _key(value: Column, k: Column) -> Column:
    """What counts as the same value: digits for cards and phones, small letters for the rest."""
    return F.concat_ws(":", k.cast("string"), F.when(k >= 2, F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value)))


def windows(found: DataFrame) -> DataFrame:
    """_row, value and window (a digest of the text beside it) of each base span. found: _row, _text, _spans."""
    cut = f"""transform(_spans, s -> named_struct('s', s,
      'before', substring(_text, greatest(s.start - {WINDOW}, 0) + 1, least(s.start, {WINDOW})), 'after', substring(_text, s.end + 1, {WINDOW})))"""
    # cut before exploding, so that a text with many values is not copied for each of them
    one = found.select("_row", F.explode(F.expr(cut)).alias("x"))
    beside = F.concat(F.lower("x.before"), F.lit("|"), F.lower("x.after"))
    return one.select("_row", _key(F.col("x.s.value"), F.col("x.s.k")).alias("value"), F.md5(beside.cast("binary")).alias("window"))


def entities_of(around: DataFrame) -> DataFrame:
    """entity, _row, window, n_docs, n_value (witnesses: documents without copies): values that stand in the same rows."""
    once = materialise(around.groupBy("value", "_row").agg(F.min("window").alias("window")), "values")
    values = once.groupBy("value").agg(F.count("*").alias("n_docs"), F.count_distinct("window").alias("n_value"), F.bit_xor(F.xxhash64("_row")).alias("rows"))
    values = values.withColumn("entity", F.xxhash64("rows", "n_docs")).drop("rows")
    return once.join(values, "value").groupBy("entity", "_row").agg(*(F.min_by(c, "value").alias(c) for c in ("window", "n_docs", "n_value")))


def words(found: DataFrame) -> DataFrame:
    """_row, term, start, end: each word that touches no base span. found: _row, _text, _spans."""
    hidden = f"""aggregate(_spans, named_struct('p', 0, 'out', ''),
      (a, s) -> named_struct('p', greatest(a.p, s.end), 'out',
        concat(a.out, substring(_text, a.p + 1, greatest(s.start - a.p, 0)), repeat('{HIDDEN}', greatest(s.end - greatest(s.start, a.p), 0)))),
      a -> concat(a.out, substring(_text, a.p + 1)))"""
    word = TERM.replace("]", HIDDEN + "]")
    df = found.select("_row", F.expr(hidden).alias("_b"))
    df = df.select("_row", F.regexp_extract_all("_b", F.lit(word), F.lit(0)).alias("_f"), F.transform(F.split("_b", word, -1), F.length).alias("_g"))
    df = df.select("_row", F.posexplode(F.expr("transform(_f, (x, i) -> named_struct('term', lower(x), 'gap', _g[i], 'n', length(x)))")).alias("at", "x"))
    end = F.sum(F.col("x.gap") + F.col("x.n")).over(Window.partitionBy("_row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    df = df.select("_row", F.col("x.term").alias("term"), (end - F.col("x.n")).cast("int").alias("start"), end.cast("int").alias("end"))
    return df.where(~F.col("term").contains(HIDDEN))


def _lower_bound(hits: Column, of: Column) -> Column:
    """The lower end of the Wilson interval of hits / of."""
    p, zz = hits / of, CONFIDENCE**2
    return (p + zz / (2 * of) - CONFIDENCE * F.sqrt(p * (1 - p) / of + zz / (4 * of * of))) / (1 + zz / of)


def _bits(hits: Column, mean: Column) -> Column:
    """Whole bits of evidence against chance: minus log2 of the Chernoff bound of P(X >= hits), X Poisson."""
    bits = (hits * F.log2(hits / mean)) - (hits - mean) / F.log(F.lit(2.0))
    return F.when(hits > mean, F.least(F.floor(bits), F.lit(MOST_BITS)).cast("int")).otherwise(0)


def bits_needed(counts: dict[int, int], tests: int) -> int:
    """The least number of bits from which on at most FALSE_DISCOVERIES of the pairs are chance. counts: pairs by their
    bits; tests: pairs that there could be."""
    needed, passing = MOST_BITS + 1, 0
    for bits in sorted(counts, reverse=True):
        passing += counts[bits]
        if tests * 0.5**bits <= FALSE_DISCOVERIES * passing:
            needed = bits
    return needed


def disclosing_terms(entities: DataFrame, used: DataFrame, docs: DataFrame, text: str, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """_row, term, k: the terms of each row that give one of its values away, over the whole corpus.
    entities: as of entities_of(), those with LEAST_WITNESSES; used: as of words(), for their rows."""
    n = float(max(docs.count(), 1))
    # P(value | term) is at most n_value / (n_term - n_docs), so that a term in more documents cannot reach the threshold
    most = F.col("n_docs") + F.least(F.col("n_value") * F.pow(n / F.col("n_value"), F.lit(1 - generalise)), F.col("n_value") / TOLD)
    limit, n_entities = entities.agg(F.max(most), F.count_distinct("entity")).first()
    limit = max(limit or 0.0, 0.0)
    spelt = F.array_distinct(F.transform(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[^\p{L}\p{N}]+"), F.lower))
    terms = docs.select(F.explode(spelt).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("n_term"))
    terms = materialise(terms.where(F.col("n_term") >= LEAST_WITNESSES), "terms")
    tests = n_entities * terms.count()
    frequent = terms.where(F.col("n_term") > max(limit, FREQUENT * n)).select("term")
    rare = used.select("_row", "term")
    if frequent.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        rare = rare.join(F.broadcast(frequent), "term", "left_anti")
    rare = rare.distinct().join(terms.where(F.col("n_term") <= limit), "term")
    pairs = materialise(entities.join(rare, "_row").where(F.col("n_term") <= most).select("entity", "_row", "term", "window", "n_value", "n_term"), "pairs")
    rated = pairs.groupBy("entity", "term").agg(
        F.count("*").alias("n_both"), F.count_distinct("window").alias("hits"), F.first("n_value").alias("n_value"), F.first("n_term").alias("n_term")
    )
    rated = rated.where(F.col("hits") >= LEAST_WITNESSES).withColumn("bits", _bits(F.col("hits"), F.col("n_value") * F.col("n_term") / n))
    rated = materialise(rated, "rated")
    needed = bits_needed({r["bits"]: r["count"] for r in rated.groupBy("bits").count().collect()}, tests)  # at most MOST_BITS + 1 rows
    of = F.col("hits") + F.greatest(F.col("n_term") - F.col("n_both"), F.lit(0))
    content = F.log2(n / F.col("n_value"))
    rated = rated.where(F.col("bits") >= needed).withColumn("low", _lower_bound(F.col("hits"), of))
    rated = rated.withColumn("disclosure", F.when(content > 0, 1 + F.log2("low") / content)).where((F.col("disclosure") >= generalise) & (F.col("low") >= TOLD))
    rated = rated.select("entity", "term", F.when(F.col("disclosure") >= remove, KINDS.index("cue")).otherwise(KINDS.index("term")).alias("k"))
    return pairs.select("entity", "_row", "term").join(rated, ["entity", "term"]).groupBy("_row", "term").agg(F.max("k").alias("k"))


def with_spans(docs: DataFrame, text: str = "text", keep: bool = True) -> DataFrame:
    """docs with _spans: base spans and those of disclosing terms, by start and kind. With keep false only doc_id
    stays of docs, so that texts without any span are not carried along."""
    base = with_base_spans(docs, text, "_spans").withColumn("_row", F.monotonically_increasing_id())
    hit = F.when(F.size("_spans") > 0, F.col(text).cast("string"))
    if keep:
        base = base.withColumn("_text", F.lit(None).cast("string"))
    else:
        base = base.select("doc_id", "_row", "_spans", hit.alias("_text"))
    base = materialise(base, "spans")  # row numbers are fixed from here on
    found = base.select("_row", F.col(text).cast("string").alias("_text") if keep else "_text", "_spans").where(F.size("_spans") > 0)
    entities = materialise(entities_of(windows(found)).where(F.col("n_value") >= LEAST_WITNESSES), "entities")
    used = materialise(words(found.join(entities.select("_row").distinct(), "_row", "left_semi")), "words")
    more = (
        used.join(disclosing_terms(entities, used, docs, text), ["_row", "term"])
        .groupBy("_row")
        .agg(F.collect_list(F.struct("start", F.col("k").cast("int").alias("k"), "end", F.lit("").alias("value"))).alias("_more"))
    )  # a row's list is bounded by its text
    out = base.join(more, "_row", "left")
    spans = F.array_sort(F.concat("_spans", F.coalesce(F.col("_more").cast(f"array<{_SPAN}>"), F.array().cast(f"array<{_SPAN}>"))))
    return out.withColumn("_all", spans).drop("_more", "_text")


def _listed(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(array({names})[s.k], ':', s.start, ':', s.end)), ',')")


def _count(k: int) -> Column:
    return F.expr(f"cast(size(filter(_spans, s -> s.k = {k})) as bigint)")


def sanitised(text: Column, spans: str) -> Column:
    """The text with each span replaced by what its kind is replaced by; a span that begins inside another goes
    with it."""
    shown = ", ".join(f"'{x}'" for x in REPLACED_BY)
    return F.expr(f"""aggregate({spans}, named_struct('p', 0, 'out', ''),
      (a, s) -> if(s.start >= a.p,
        named_struct('p', s.end, 'out', concat(a.out, substring(_t, a.p + 1, s.start - a.p), array({shown})[s.k])),
        named_struct('p', greatest(a.p, s.end), 'out', a.out)),
      a -> concat(a.out, substring(_t, a.p + 1)))""")


def op4_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return with_spans(docs, keep=False).select(
        "doc_id",
        *(_count(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)),
        F.sha2(_listed("_spans").cast("binary"), 256).alias("base_sha256"),
        _listed("_all").alias("spans"),
    )


#: Kinds of the contract and their patterns, spelt as it spells them.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid_sql() -> str:
    """SQL relations: d (row, doc_id, t) and valid (row, kind, k, x, digits, start, stop), the base spans; matches and
    what stands between them give the places."""
    found = " UNION ALL ".join(f"SELECT row, '{kind}' AS kind, {k} AS k, regexp_extract_all(t, '{x}') AS m, string_split_regex(t, '{x}') AS g FROM d" for k, (kind, x) in enumerate(_PLAIN.items()))
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents), found AS ({found}), one AS (
      SELECT row, kind, k, m, g, unnest(range(1, len(m) + 1)) AS i FROM found
    ), spans AS (
      SELECT row, kind, k, m[i] AS x, regexp_replace(m[i], '[^0-9]', '', 'g') AS digits,
        list_sum(list_transform(g[1 : i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda y: length(y))), 0) AS start FROM one
    ), doubled AS (
      SELECT *, list_transform(range(length(digits)), lambda j: digits[length(digits) - j]::INT * (1 + j % 2)) AS twice FROM spans
    ), valid AS MATERIALIZED (
      SELECT row, kind, k, x, digits, start::BIGINT AS start, (start + length(x))::BIGINT AS stop FROM doubled WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(x, '.'), lambda y: y::HUGEINT > 255)) = 0
        WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(twice, lambda y: y // 10 + y % 10)) % 10 = 0
        ELSE length(digits) BETWEEN 10 AND 15 END
    ), listed AS (
      SELECT row, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS base,
        {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _PLAIN)} FROM valid GROUP BY row
    )"""


_BASE_COLUMNS = f"d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in _PLAIN)}, sha256(coalesce(base, '')) AS base_sha256"
BASE_SQL = f"{_valid_sql()} SELECT {_BASE_COLUMNS} FROM d LEFT JOIN listed ON listed.row = d.row"

#: All columns: the base spans, then entities, witnesses, chance and disclosure by joins and aggregates.
OP4_SQL = f"""{_valid_sql()}, held AS (
  SELECT row, k || ':' || CASE WHEN k >= 2 THEN digits ELSE lower(x) END AS value,
    min(md5(lower(substring(t, greatest(start - {WINDOW}, 0) + 1, least(start, {WINDOW}))) || '|' || lower(substring(t, stop + 1, {WINDOW})))) AS beside
  FROM valid JOIN d USING (row) GROUP BY ALL
), by_value AS (
  SELECT value, count(*) AS n_docs, count(DISTINCT beside) AS n_value, md5(list(row ORDER BY row)::VARCHAR) AS entity FROM held GROUP BY value
), entities AS MATERIALIZED (
  SELECT entity, row, arg_min(beside, value) AS beside, min(n_docs)::DOUBLE AS n_docs, arg_min(n_value, value)::DOUBLE AS n_value
  FROM held JOIN by_value USING (value) GROUP BY entity, row HAVING arg_min(n_value, value) >= {LEAST_WITNESSES}
), terms AS MATERIALIZED (
  SELECT term, count(*)::DOUBLE AS n_term FROM (SELECT DISTINCT row, lower(unnest(regexp_extract_all(t, '{TERM}'))) AS term FROM d)
  GROUP BY term HAVING count(*) >= {LEAST_WITNESSES}
), split AS (
  SELECT row, regexp_extract_all(t, '{TERM}') AS m, string_split_regex(t, '{TERM}') AS g FROM d WHERE row IN (SELECT row FROM entities)
), apart AS (
  SELECT row, unnest(m) AS x, unnest(g[1 : len(m)]) AS g, unnest(range(len(m))) AS i FROM split
), placed AS (
  SELECT row, lower(x) AS term, length(x) AS size, (sum(length(g) + length(x)) OVER (PARTITION BY row ORDER BY i))::BIGINT AS stop FROM apart
), words AS MATERIALIZED (
  SELECT row, term, stop - size AS start, stop FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.row = p.row AND v.start <= p.stop AND p.stop - p.size <= v.stop)
), total AS (
  SELECT greatest(count(*), 1)::DOUBLE AS n FROM d
), pairs AS MATERIALIZED (
  SELECT entity, row, term, beside, n_docs, n_value, n_term, n FROM entities JOIN (SELECT DISTINCT row, term FROM words) USING (row) JOIN terms USING (term), total
  WHERE n_term <= n_docs + least(n_value * pow(n / n_value, {1 - GENERALISE}e0), n_value / {TOLD}e0)
), rated AS (
  SELECT entity, term, n, n_value, n_term, count(DISTINCT beside)::DOUBLE AS hits, count(DISTINCT beside) + greatest(n_term - count(*), 0) AS total
  FROM pairs GROUP BY entity, term, n, n_value, n_term HAVING count(DISTINCT beside) >= {LEAST_WITNESSES}
), weighed AS MATERIALIZED (
  SELECT *, n_value * n_term / n AS mean, hits / total AS p,
    CASE WHEN hits > mean THEN least(floor(hits * log2(hits / mean) - (hits - mean) / ln(2e0)), {MOST_BITS}) ELSE 0 END AS bits FROM rated
), steps AS (
  SELECT bits, sum(count(*)) OVER (ORDER BY bits DESC) AS passing FROM weighed GROUP BY bits
), needed AS (
  SELECT min(bits) AS least FROM steps
  WHERE (SELECT count(DISTINCT entity) FROM entities) * (SELECT count(*) FROM terms) * pow(0.5e0, bits) <= {FALSE_DISCOVERIES}e0 * passing
), bounded AS (
  SELECT *, (p + {CONFIDENCE**2}e0 / (2 * total) - {CONFIDENCE}e0 * sqrt(p * (1 - p) / total + {CONFIDENCE**2}e0 / (4 * total * total))) / (1 + {CONFIDENCE**2}e0 / total) AS low
  FROM weighed, needed WHERE bits >= least
), told AS (
  SELECT entity, term, 1 + log2(low) / log2(n / n_value) AS disclosure FROM bounded WHERE low >= {TOLD}e0 AND n > n_value
), marked AS (
  SELECT row, term, max(CASE WHEN disclosure >= {REMOVE}e0 THEN 5 ELSE 4 END) AS k
  FROM pairs JOIN told USING (entity, term) WHERE disclosure >= {GENERALISE}e0 GROUP BY row, term
), every AS (
  SELECT row, kind, k, start, stop FROM valid
  UNION ALL SELECT row, CASE k WHEN 5 THEN 'cue' ELSE 'term' END, k, start, stop FROM words JOIN marked USING (row, term)
), shown AS (
  SELECT row, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM every GROUP BY row
)
SELECT {_BASE_COLUMNS}, coalesce(spans, '') AS spans FROM d LEFT JOIN listed ON listed.row = d.row LEFT JOIN shown ON shown.row = d.row
"""


def sanitise(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data replaced, disclosing terms generalised or removed; all documents stay."""
    names = docs.columns
    packed = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in names if c != "text")).alias("_doc"))  # no name clashes
    done = with_spans(packed, keep=True).withColumn("_t", F.col("text").cast("string"))
    done = done.withColumn("_new", F.when(F.size("_all") > 0, sanitised(F.col("_t"), "_all")).otherwise(F.col("_t")))
    shown = {"text": F.col("_new").cast(docs.schema["text"].dataType)}
    if "n_chars" in names:
        shown["n_chars"] = F.when(F.size("_all") > 0, F.length("_new")).otherwise(F.col("_doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.select(*(shown[c].alias(c) if c in shown else F.col("_doc")[c].alias(c) for c in names))

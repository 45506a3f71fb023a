"""Scalar cases: expressions against a restatement in plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from varaq.functions import rules, text


def values(spark, items, f):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "k int, x string")
    return [r.v for r in df.select("k", f(F.col("x")).alias("v")).orderBy("k").collect()]


LETTERS = "ابتيكةىأإؤۀٱـ‌‏ًّ" + "۱۲۳٤٥٦" + "abc 12.,:;()[]{}|-–—_/\\\t\r\n\xa0 \x1c　?٫٬"


def samples(n=1500, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 25))) for _ in range(n)]


def test_numbers_and_glyph_order(spark):
    words = samples() + ["هعماج", "2٩", "१२", "𝟗5", "(๔๕)", "(۱۲).", "Word", "۱۲٬", "", "."]

    def number(w):
        s = w.strip(".,:;()[]{}٫٬")
        return bool(s) and all(unicodedata.category(c) == "Nd" for c in s)

    assert values(spark, words, text.is_number) == [number(w) for w in words]
    script = lambda w: bool(re.search("[؀-ۿ‌‏]", w))
    assert values(spark, words, text.contains_script) == [script(w) for w in words]
    assert values(spark, words, text.fix_glyphs) == [w if number(w) or not script(w) else w[::-1] for w in words]
    digits = ["".join(str(unicodedata.digit(c)) for c in w if unicodedata.category(c) == "Nd") for w in words]
    assert values(spark, words, text.digits_to_int) == [int(d) if d else None for d in digits]


def test_strip_and_noise_lines(spark):
    items = samples(800, 5) + ["12\n---\nab\n x \n", "a", "\n\n"]
    assert values(spark, items, text.strip) == [x.strip() for x in items]

    def noise(t):
        lines = [x.strip() for x in t.split("\n")]
        return "\n".join(x for x in lines if len(x) > 1 and not re.fullmatch(r"[\d\s\-–—_.:|/\\]+", x))

    assert values(spark, items, text.drop_noise_lines) == [noise(x) for x in items]


def test_clean_cases(spark):
    cases = {None: "", "": "", "كتابي": "کتابی", "فصـل": "فصل", ")1(": "(1)", "a) and (b": "a( and )b", "ab\n12\n---\ncd": "ab\ncd", "a\t\tb\r\n\n\n\ncd": "a b\ncd"}
    cases["a\t\tb\r\n\n\n\ncd"] = "a b\ncd"
    assert values(spark, list(cases), text.clean) == list(cases.values())


def test_labels(spark):
    cases = [
        ("فصل اول: جامعه", ("فصل", 1, 0, "جامعه")),
        ("فصل ا ّول: x", ("فصل", 1, 0, "x")),
        ("کنش درس دوم : ما", ("درس", 2, 4, "ما")),
        ("درس بیست‌ویکم : x", None),
        ("درس خوب فصل اول", None),  # only the first hit counts
        ("x درس\nسوم\ny", ("درس", 3, 2, "y")),
        ("a long text before the درس اول", None),
        ("nothing", None),
    ]
    got = values(spark, [x for x, _ in cases], lambda c: text.label(c, 15))
    assert [tuple(g) if g else None for g in got] == [e for _, e in cases]
    assert values(spark, ["a long text before the درس اول"], text.label)[0].order == 1


def test_captions(spark):
    got = values(spark, ["Title: A\nگزینه: x\nدرس: فلسفه\ntitle: B\ngrade: ??\nپایه: 11", None, "", "no colon", "title: " + "x" * 201, "x" * 2001 + "\ntitle: a"], text.caption_fields)
    assert tuple(got[0]) == ("B", "فلسفه", "11")
    assert all(tuple(g) == (None, None, None) for g in got[1:])


def test_scores_and_colours(spark):
    line = lambda t, size, colored, bold: rules.classified(F.lit(t), F.lit(float(size)), F.lit(colored), F.lit(bold), F.lit(12.0))
    cases = [
        (line("x", 30, False, False), ("heading", 0.5, "size_ratio=2.50")),
        (line("x", 12, False, False), ("paragraph", 1.0, "body_text")),
        (line("x", 12, True, True), ("heading", 0.5, "colored_ink; bold_font")),
        (line("x" * 150, 16, False, False), ("paragraph", 1.0, "size_ratio=1.33; long_line_penalty")),
        (line("x" * 150, 30, True, True), ("heading", 0.6, "size_ratio=2.50; colored_ink; bold_font; long_line_penalty")),
        (line(" ", 30, True, True), ("paragraph", 1.0, "empty_line")),
    ]
    row = spark.range(1).select(*(c.alias(f"c{k}") for k, (c, _) in enumerate(cases))).first()
    for k, (_, want) in enumerate(cases):
        assert (row[k][0], round(row[k][1], 9), row[k][2]) == want
    colors = [(None, True), ([], True), ([0.5], True), ([0.1, 0.12, 0.11], True), ([0.9, 0.1, 0.1], False), ([0.0, 0.6, 0.9, 0.0], False), ([0.1, 0.9], True)]
    df = spark.createDataFrame([(k, c) for k, (c, _) in enumerate(colors)], "k int, c array<double>")
    assert [r.v for r in df.select("k", rules.is_grey(F.col("c")).alias("v")).orderBy("k").collect()] == [v for _, v in colors]


def test_file_names_and_lists(spark):
    names = ["../../etc/passwd", "a\\b.pdf", "x\x00y.PDF", None, "", " . ", "کتاب (1).pdf", "n" * 300, "a⁄b.pdf"]
    got = values(spark, names, lambda c: rules.safe_pdf_name(rules.nfkc(c), F.lit("7")))
    assert all(g.lower().endswith(".pdf") and "/" not in g and "\\" not in g and "\x00" not in g and len(g) <= 184 for g in got)
    assert got[3] == got[4] == got[5] == "document-7.pdf" and got[6] == "کتاب (1).pdf"
    lists = values(spark, ["1, 2,1", "1,x", "", "0,1", "5,,6", None, "+3"], rules.allow_list)
    assert lists == [[1, 2], [], [], [], [], [], [3]]
    assert spark.range(1).select(rules.mean_confidence(F.array(F.lit("80"), F.lit("-1"), F.lit("invalid")))).first()[0] == 80.0


def test_a_text_is_cleaned_in_few_passes_with_the_rows_of_all_its_steps(spark):
    """Each pass over the pages of a library costs as much as spelling them; clean() took three translations and ten
    replacements. Lines of white space in every place, and double spaces, come out as from one step after the other."""
    steps = lambda c: text.strip(text.normalise_spaces(text.drop_noise_lines(text.normalise_spaces(text.fix_brackets(text.normalise_letters(c))))))
    pieces = ["ab", "ك", "ـ", "۱", " ", "  ", "\t", "\r", "\n", "\xa0", "　", " ", ")", "(", "]x[", "}y{", "-", "😀"]
    rng = random.Random(5)
    items = samples(seed=6) + ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(3000)]
    assert values(spark, items, text.clean) == values(spark, items, steps)
    p = spark.range(1).select(text.clean(F.col("id").cast("string")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("translate(") == 3, p  # one, told again in the question and its branches, done once
    assert len(re.findall(r"regexp_replace\(", p)) == 4, p


def test_bands_need_no_decimals(spark):
    from varaq.operators.lines import band

    df = spark.range(40000).select(((F.col("id") - 20000) / F.lit(4e0)).alias("y")).union(spark.createDataFrame([(None,)], "y double"))
    assert df.where(~band(F.col("y")).eqNullSafe(F.bround(F.col("y") / 3e0) * 3e0)).count() == 0
    assert "bround" not in df.select(band(F.col("y")))._jdf.queryExecution().optimizedPlan().toString()

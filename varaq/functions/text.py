"""Text functions for Persian pages, as Column to Column expressions that stay inside Catalyst."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and mappings that results depend on.

#: What Unicode calls white space, and the four separators U+001C to U+001F.
SPACE = r"\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Arabic block, zero-width non-joiner, right-to-left mark.
SCRIPT = r"[\x{600}-\x{6ff}\x{200c}\x{200f}]"
#: Punctuation that may stand around a number.
AROUND_NUMBERS = r"[.,:;()\[\]{}\x{66b}\x{66c}]"
#: Letters and what they become; the tatweel goes.
LETTERS = {"ي": "ی", "ى": "ی", "ك": "ک", "ۀ": "ه", "ة": "ه", "ؤ": "و", "إ": "ا", "أ": "ا", "ٱ": "ا", "ـ": ""}
CHAPTER, LESSON = "فصل", "درس"
ORDINALS = {
    "اول": 1,
    "یکم": 1,
    "دوم": 2,
    "سوم": 3,
    "چهارم": 4,
    "پنجم": 5,
    "ششم": 6,
    "هفتم": 7,
    "هشتم": 8,
    "نهم": 9,
    "دهم": 10,
    "یازدهم": 11,
    "دوازدهم": 12,
    "سیزدهم": 13,
    "چهاردهم": 14,
    "پانزدهم": 15,
    "شانزدهم": 16,
    "هفدهم": 17,
    "هجدهم": 18,
    "نوزدهم": 19,
    "بیستم": 20,
}
CAPTION_KEYS = {
    "title": "book_title",
    "book_title": "book_title",
    "عنوان": "book_title",
    "course": "course",
    "درس": "course",
    "رشته": "course",
    "grade": "grade",
    "پایه": "grade",
}


#: The decimal digits of all scripts, and the same characters that SPACE is a class of.
DIGITS = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_IN_LINE = SPACE.replace(r"\n\x0b", r"\x0b")  # white space that ends no line


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).rlike(rf"[^{SPACE}]")


def contains_script(c: Column) -> Column:
    return c.rlike(SCRIPT)


def is_number(c: Column) -> Column:
    return c.rlike(rf"\A{AROUND_NUMBERS}*\p{{Nd}}+{AROUND_NUMBERS}*\z")


def digits_to_int(c: Column) -> Column:
    """The digits, of whatever script, as one number; null without digits or beyond a long."""
    plain = F.translate(F.regexp_replace(c, r"[^\p{Nd}]", ""), "".join(DIGITS), "".join(str(unicodedata.decimal(x)) for x in DIGITS))
    return plain.try_cast("bigint")


def fix_glyphs(c: Column) -> Column:
    """Words in Arabic script were stored mirrored; numbers and others were not. Most words fail the first question."""
    return F.when(contains_script(c) & ~is_number(c), F.reverse(c)).otherwise(c)


def fix_brackets(c: Column) -> Column:
    """Brackets that stand the wrong way round; most texts have none and are looked through once."""
    inner = r"([^()\[\]{}]{1,6})"
    wrong = (rf"\){inner}\(", rf"\]{inner}\[", rf"\}}{inner}\{{")
    fixed = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, wrong[0], "($1)"), wrong[1], "[$1]"), wrong[2], "{$1}")
    return F.when(c.rlike("|".join(wrong)), fixed).otherwise(c)


def normalise_letters(c: Column, further: dict[str, str] | None = None) -> Column:
    letters = LETTERS | (further or {})
    kept = {k: v for k, v in letters.items() if v}  # translate drops what has no counterpart, at the end
    return F.translate(c, "".join([*kept, *(k for k in letters if k not in kept)]), "".join(kept.values()))


_BREAKS = {"\r": "\n", "\t": " "}


def normalise_spaces(c: Column) -> Column:
    c = F.translate(c, "".join(_BREAKS), "".join(_BREAKS.values()))
    return F.regexp_replace(F.regexp_replace(c, " {2,}", " "), "\n{3,}", "\n\n")


#: What goes of a text's lines, found in one pass: lines of one character, or of digits, white space and rules only, with
#: their ends; white space where a line begins; and where it ends, in possessive runs that begin where a run begins.
_NOISE = (
    rf"(?md)^(?:(?:[\p{{Nd}}{_IN_LINE}\x{{2013}}\x{{2014}}_.:|/\\-]*+|[{_IN_LINE}]*+[^\n][{_IN_LINE}]*+)(?:\n|\z)|[{_IN_LINE}]++)"
    rf"|[{_IN_LINE}](?<![{_IN_LINE}][{_IN_LINE}])[{_IN_LINE}]*+(?![^\n])"
)


def drop_noise_lines(c: Column) -> Column:
    """Lines of one character, or of digits, white space and rules only, go; the rest is stripped line by line."""
    return F.rtrim(F.regexp_replace(c, _NOISE, ""), F.lit("\n"))


def clean(c: Column) -> Column:
    """Letters, brackets, spaces and noise, each as its function above has it.

    The steps share their passes over the text, the costliest of a page: letters and breaks are translated at once; spaces
    after a space go with the noise; and where no line is blank or has white space at its ends, none of a text's is left.
    """
    c = fix_brackets(normalise_letters(F.coalesce(c, F.lit("")), _BREAKS))
    return F.rtrim(F.regexp_replace(c, rf"{_NOISE}| (?<=  ) *+", ""), F.lit("\n"))


def fix_first(c: Column) -> Column:
    """The word for "first" comes out with a gap at its doubling mark."""
    return F.regexp_replace(c, rf"ا[{SPACE}]*\x{{651}}?[{SPACE}]*ول(?![\p{{L}}\p{{N}}_])", "اول")


def arabic_letters(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x{600}-\x{6ff}]", "")


def ordinal(c: Column) -> Column:
    pairs = [x for k, v in ORDINALS.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), arabic_letters(c))


_LABEL = rf"(?d)\A((?s:.*?))({CHAPTER}|{LESSON})[{SPACE}]+([^{SPACE}]+)[{SPACE}]*:?[{SPACE}]*([^\n]*)\n?\z"


def label(c: Column, max_prefix: int | None = None) -> Column:
    """struct(kind, order, start, rest) of the first chapter or lesson label, or null.

    Only the first hit counts: if its ordinal is unknown, or too much stands before it, there is no label.
    """
    fixed = fix_first(c)
    part = lambda k: F.regexp_extract(fixed, _LABEL, k)
    order, start = ordinal(part(3)), F.length(part(1))
    ok = (part(2) != "") & order.isNotNull()
    if max_prefix is not None:
        ok = ok & (start <= max_prefix)
    return F.when(ok, F.struct(part(2).alias("kind"), order.alias("order"), start.alias("start"), strip(part(4)).alias("rest")))


def suspicious(c: Column) -> Column:
    """Two question marks in a row: the text went through a wrong encoding."""
    return F.coalesce(c.rlike(r"\?{2,}"), F.lit(False))


def caption_fields(caption: Column, max_chars: int = 2000, max_value: int = 200) -> Column:
    """struct(book_title, course, grade) from "key: value" lines; of several, the last valid line holds."""
    pairs = [x for k, v in CAPTION_KEYS.items() for x in (F.lit(k), F.lit(v))]
    breaks = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"
    lines = F.filter(F.split(caption, breaks, -1), lambda x: x.contains(":"))
    read = F.transform(
        lines,
        lambda x: F.struct(
            F.try_element_at(F.create_map(*pairs), F.lower(strip(F.substring_index(x, ":", 1)))).alias("key"),
            strip(F.regexp_replace(x, r"\A[^:]*:", "")).alias("value"),
        ),
    )
    valid = F.filter(read, lambda p: p["key"].isNotNull() & F.length(p["value"]).between(1, max_value) & ~suspicious(p["value"]))
    usable = F.when(F.length(caption).between(1, max_chars), valid)
    last = lambda key: F.try_element_at(F.filter(usable, lambda p: p["key"] == key), F.lit(-1))["value"].alias(key)
    return F.struct(last("book_title"), last("course"), last("grade"))


def cell_text(c: Column) -> Column:
    """A cell as it stands in a Markdown table."""
    return F.coalesce(F.nullif(F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|")), F.lit("")), F.lit(" "))

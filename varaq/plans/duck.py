"""The engine's text functions and relations as DuckDB SQL, spelt on their own, to hold results against: what the
classes, words and tables of the engine are is written here once more, so that a slip there shows."""

from __future__ import annotations

import re

from varaq.plans.inputs import DUCK, with_tables

# Fixed values that results depend on.
S = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x{85}\x{a0}\x{1680}\x{2000}\x{2001}\x{2002}\x{2003}\x{2004}\x{2005}\x{2006}\x{2007}\x{2008}\x{2009}\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SCRIPT = r"[\x{200c}\x{200f}\x{600}-\x{6ff}]"
AROUND_NUMBERS = r"[(){}\[\].,:;٫٬]"
CHAPTER, LESSON = "فصل", "درس"
ORDINALS = dict(
    zip("اول دوم سوم چهارم پنجم ششم هفتم هشتم نهم دهم یازدهم دوازدهم سیزدهم چهاردهم پانزدهم شانزدهم هفدهم هجدهم نوزدهم بیستم".split(), range(1, 21), strict=True)
) | {"یکم": 1}
CAPTION_KEYS = {"book_title": "book_title title عنوان", "course": "course درس رشته", "grade": "grade پایه"}
ENTRY = rf"\A(.+?)\.{{2,}}[{S}]*([0-9٠-٩۰-۹]+)[{S}]*\z"
STATES = {
    "received": "✅ فایل دریافت شد", "validating": "🔎 در حال اعتبارسنجی فایل", "queued": "⏳ در صف پردازش", "downloading": "📥 در حال آماده‌سازی فایل", "ready": "✅ فایل آماده پردازش است",
    "processing": "⚙️ در حال پردازش", "extracting": "📖 در حال استخراج متن", "ocr": "🔎 در حال اجرای OCR", "exporting": "📦 در حال ساخت خروجی‌ها", "completed": "✅ پردازش کامل شد",
    "failed": "❌ پردازش ناموفق بود", "cancel_requested": "🛑 درخواست لغو ثبت شد", "cancelled": "🛑 پردازش لغو شد",
}
RELATION_TYPES = ("prerequisite", "depends_on", "parent", "child", "related", "similar", "opposite", "frequently_confused")
def sub(e: str, pattern: str, to: str) -> str:
    return f"regexp_replace({e}, '{pattern}', '{to}', 'g')"


def strip(e: str) -> str:
    return sub(e, rf"\A[{S}]+|[{S}]+\z", "")


def has(e: str, pattern: str) -> str:
    return f"regexp_matches({e}, '{pattern}')"


def blank(e: str) -> str:
    return f"not {has(f'coalesce({e}, chr(32))', f'[^{S}]')}"


def is_number(e: str) -> str:
    return has(e, rf"\A{AROUND_NUMBERS}*\p{{Nd}}+{AROUND_NUMBERS}*\z")


def digits_to_int(e: str) -> str:
    """Of the scripts that the inputs have."""
    return f"try_cast(translate({sub(e, r'[^\p{Nd}]', '')}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789') as bigint)"


def reverse(e: str) -> str:
    return f"array_to_string(list_transform(range(length({e})), lambda k: substring({e}, (length({e}) - k)::bigint, 1)), '')"


def fix_glyphs(e: str) -> str:
    return f"case when {is_number(e)} then {e} when {has(e, SCRIPT)} then {reverse(e)} else {e} end"


def fix_brackets(e: str) -> str:
    inner = r"([^()\[\]{}]{1,6})"
    return sub(sub(sub(e, rf"\){inner}\(", r"(\1)"), rf"\]{inner}\[", r"[\1]"), rf"\}}{inner}\{{", r"{\1}")


def letters(e: str) -> str:
    return f"translate({e}, 'يىكۀةؤإأٱـ', 'ییکههوااا')"


def spaces(e: str) -> str:
    return sub(sub(f"translate({e}, '\r\t', '\n ')", " {2,}", " "), "\n{3,}", "\n\n")


def noise(e: str) -> str:
    rule = rf"\A[\p{{Nd}}{S}\x{{2013}}\x{{2014}}_.:|/\\-]+\z"
    return f"array_to_string(list_filter(list_transform(string_split({e}, '\n'), lambda x: {strip('x')}), lambda x: length(x) > 1 and not {has('x', rule)}), '\n')"


def clean(e: str) -> str:
    return strip(spaces(noise(spaces(fix_brackets(letters(f"coalesce({e}, '')"))))))


def fix_first(e: str) -> str:
    return sub(e, rf"ا[{S}]*\x{{651}}?[{S}]*ول([^\p{{L}}\p{{N}}_]|\z)", r"اول\1")


def ordinal(e: str) -> str:
    return f"case {sub(e, r'[^\x{600}-\x{6ff}]', '')} " + " ".join(f"when '{k}' then {v}" for k, v in ORDINALS.items()) + " end"


LABEL = rf"\A((?s:.*?))({CHAPTER}|{LESSON})[{S}]+([^{S}]+)[{S}]*:?[{S}]*([^\n]*)\n?\z"


def label(e: str, k: int) -> str:
    return f"regexp_extract({fix_first(e)}, '{LABEL}', {k})"


def entry(e: str, k: int) -> str:
    return f"regexp_extract({e}, '{ENTRY}', {k})"


def grey(c: str) -> str:
    return f"(coalesce(len({c}), 0) < 3 or greatest(abs({c}[1] - {c}[2]), abs({c}[2] - {c}[3]), abs({c}[1] - {c}[3])) < 0.08e0)"


RATIO = "(avg_size / case when baseline > 0 then baseline else 12e0 end)"
SCORE = f"(case when {RATIO} >= 1.5e0 then 0.5e0 when {RATIO} >= 1.15e0 then 0.25e0 else 0e0 end + case when is_colored then 0.35e0 else 0e0 end + case when is_bold then 0.15e0 else 0e0 end + case when length(text) > 100 then -0.4e0 else 0e0 end)"
REASON = f"concat_ws('; ', case when {RATIO} >= 1.15e0 then printf('size_ratio=%.2f', {RATIO}) end, case when is_colored then 'colored_ink' end, case when is_bold then 'bold_font' end, case when length(text) > 100 then 'long_line_penalty' end)"

_BEFORE = "partition by book order by seq rows between unbounded preceding and current row"
_NOBLANK = f"list_filter(flatten(rows), lambda x: not ({blank('x')}))"
_CELL = "replace(replace(x, chr(10), ' '), '|', '\\|')"
_LINE = f"concat('| ', array_to_string(list_transform(list_concat(r, list_transform(range(w - len(r)), lambda z: '')), lambda x: case when {_CELL} = '' then ' ' else {_CELL} end), ' | '), ' |')"


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


#: Relations; each names those that it is built from.
TABLES = DUCK | {
    "lines": (
        ("words",),
        f"select book, page, round_even(top / 3, 0) * 3 as band, string_agg({fix_glyphs('text')}, ' ' order by -x0, word_no) as text, min(top) as top, max(bottom) as bottom, min(x0) as x0, max(x1) as x1, "
        f"avg(coalesce(size, 0)) as avg_size, bool_or(contains(lower(coalesce(fontname, '')), 'bold')) as is_bold, bool_or(coalesce(len(color), 0) > 0 and not {grey('color')}) as is_colored from words group by 1, 2, 3",
    ),
    "baselines": (("lines",), f"select book, coalesce(median(case when avg_size <> 0 and not ({blank('text')}) then avg_size end), 12e0) as baseline from lines group by 1"),
    "classified": (
        ("lines", "baselines"),
        f"select lines.*, baseline, case when not ({blank('text')}) and {SCORE} >= 0.5e0 then 'heading' else 'paragraph' end as type, "
        f"case when {blank('text')} then 1e0 when {SCORE} >= 0.5e0 then least({SCORE}, 1e0) else least(greatest(1e0 - {SCORE}, 0.5e0), 1e0) end as confidence, "
        f"case when {blank('text')} then 'empty_line' when {REASON} = '' then 'body_text' else {REASON} end as reason from lines join baselines using (book)",
    ),
    "page_text": (("lines",), f"select book, page, {clean('t')} as text from (select book, page, string_agg(text, '\n' order by band) as t from lines group by 1, 2)"),
    "table_rows": (
        ("cells",),
        "select book, page, table_no, row_no, list(coalesce(text, '') order by col_no) as r, count(*) as width, "
        f"count(*) filter (where not ({blank('text')})) as filled, max(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '\n', ''))) as newlines, min(top) as top, "
        "any_value(table_x0) as table_x0, any_value(table_top) as table_top, any_value(table_x1) as table_x1, any_value(table_bottom) as table_bottom, any_value(page_w) as page_w, any_value(page_h) as page_h "
        "from cells group by 1, 2, 3, 4",
    ),
    "tables": (
        ("table_rows",),
        "select book, page, table_no, list(r order by row_no) as rows, count(*) as n_rows, max(width) as n_cols, sum(width)::bigint as n_cells, sum(filled)::bigint as n_filled, max(newlines) as max_newlines, "
        "coalesce(min(top), 0e0) as top, any_value(table_top) as table_top, any_value(table_bottom) as table_bottom, sum(filled)::double / sum(width)::double as fill, "
        "(any_value(table_x1) - any_value(table_x0)) * (any_value(table_bottom) - any_value(table_top)) / (any_value(page_w) * any_value(page_h)) as area from table_rows group by 1, 2, 3",
    ),
    "accepted": (("tables",), "select * from tables where n_rows >= 2 and n_cols >= 2 and not (area > 0.5e0 and max_newlines > 15) and n_filled > 0"),
    "labelled": (
        ("accepted",),
        f"select *, case when fill >= 0.5e0 then 'table' when length(array_to_string({_NOBLANK}, ' — ')) <= 60 then 'heading' else 'paragraph' end as type, "
        f"case when fill >= 0.5e0 then array_to_string(list_transform(rows, lambda r: array_to_string(r, ' | ')), '\n') else array_to_string({_NOBLANK}, ' — ') end as block_text, "
        f"case when fill >= 0.5e0 then round_even(fill, 2) when length(array_to_string({_NOBLANK}, ' — ')) <= 60 then 0.4e0 else 0.3e0 end as confidence, round_even(fill, 2) as fill_ratio from accepted",
    ),
    "outside": (
        ("cell_lines", "accepted"),
        "select * from cell_lines l where not exists (select 1 from accepted t where t.book = l.book and t.page = l.page and l.top >= t.table_top - 1 and l.bottom <= t.table_bottom + 1)",
    ),
    "items": (
        ("outside", "labelled"),
        f"select book, page, top, 0 as kind, band as seq, type, text, confidence, reason, null::double as fill_ratio from outside where not ({blank('text')}) "
        "union all select book, page, top, 1, table_no::double, type, block_text, confidence, null, fill_ratio from labelled",
    ),
    "islands": (
        ("items",),
        "select *, sum(case when flowing and coalesce(before, false) then 0 else 1 end) over (partition by book, page order by top, kind, seq rows between unbounded preceding and current row) as block_index "
        "from (select *, lag(flowing) over (partition by book, page order by top, kind, seq) as before from (select *, kind = 0 and type = 'paragraph' as flowing from items))",
    ),
    "blocks": (
        ("islands",),
        f"select book, page, block_index::bigint as block_index, concat(page, '-', block_index::bigint) as id, any_value(type) as type, case when any_value(kind) = 1 then string_agg(text, '\n' order by top, kind, seq) else "
        f"{clean(chr(39).join(['string_agg(text, ', chr(10), ' order by top, kind, seq)']))} end as text, case when not any_value(flowing) then round_even(any_value(confidence), 2) end as confidence, "
        "case when not any_value(flowing) then any_value(reason) end as reason, any_value(fill_ratio) as fill_ratio, case when any_value(kind) = 1 then min(top) end as top, case when any_value(kind) = 1 then 'bordered_region' end as source from islands group by book, page, block_index",
    ),
    "short_text": (
        ("page_text", "listed"),
        "select book, page, case when error is null and text_error is null then coalesce(text, '') else '' end as text, text_error, structure_error from page_text full join listed using (book, page)",
    ),
    "page_ocr": (
        ("short_text",),
        "select book, page, case page % 4 when 0 then 'x' when 1 then null else concat(repeat('کتاب ', page % 9 + 1), text) end as text, case when page % 5 = 0 then null else 40e0 + page % 10 + 0.25e0 end as confidence, "
        "case page % 4 when 1 then 'engine stopped' else null end as error from short_text where text_error is null and length(text) < 30",
    ),
    "pages_seen": (
        ("short_text", "page_ocr"),
        f"select p.book, p.page, p.text as own, p.text_error as broken, p.structure_error, {clean('o.text')} as ocr_text, o.confidence as conf, o.error as err, p.text_error is null and length(p.text) < 30 as short, "
        f"p.text_error is null and length(p.text) < 30 and o.error is null and length({clean('o.text')}) > length(p.text) as better from short_text p left join page_ocr o using (book, page)",
    ),
    "page_status": (
        ("pages_seen",),
        "select book, page, case when better then ocr_text else own end as text, length(case when better then ocr_text else own end) as char_count, "
        "case when broken is not null then 'failed' when better then 'ocr_tesseract' when own = '' then 'empty' else 'pdfplumber_positional' end as method, broken is null and length(case when better then ocr_text else own end) < 30 as needs_review, "
        "concat_ws('|', case when broken is not null then concat('PAGE_EXTRACTION_FAILED: ', broken) end, case when short then 'LOW_TEXT_MAY_NEED_OCR' end, case when better and conf < 45 then concat('OCR_LOW_CONFIDENCE:', printf('%.1f', conf)) end, case when better then 'RECOVERED_VIA_OCR' end, "
        "case when short and err is not null then concat('OCR_FAILED: ', err) end, "
        "case when broken is null and not better and own <> '' and structure_error is not null then concat('BLOCK_STRUCTURING_FAILED: ', structure_error) end) as warnings from pages_seen",
    ),
    "counts": (
        ("page_status",),
        "select book, count(*) as total_pages, count(*) filter (where char_count > 0) as with_text, count(*) filter (where char_count = 0) as without_text, count(*) filter (where needs_review) as to_review, "
        "count(*) filter (where method = 'ocr_tesseract') as ocr_pages from page_status group by 1",
    ),
    "entries": (
        ("toc",),
        f"select book, seq, {strip('array_to_string(list(part order by page, line_no), chr(32))')} as title, max(number) as page from (select *, case when entry then {strip(entry('line', 1))} else line end as part, "
        f"case when entry then {digits_to_int(entry('line', 2))} end as number from (select *, coalesce(sum(case when entry then 1 else 0 end) over (partition by book order by page, line_no rows between unbounded preceding and 1 preceding), 0)::bigint as seq "
        f"from (select book, page, line_no, l as line, {entry('l', 2)} <> '' as entry from (select *, {strip('line')} as l from toc) where l <> '' and l <> 'فهرست'))) group by 1, 2 having bool_or(entry)",
    ),
    "roles": (
        ("entries",),
        f"select *, case when o is null then 'subtopic' when kind = '{CHAPTER}' then 'chapter' else 'lesson' end as role, "
        f"case when o is null or named = '' then title else named end as shown from (select *, case when kind <> '' and start <= 15 then n end as o, "
        f"{strip('concat_ws(chr(32), nullif(before, chr(0)), nullif(rest, chr(0)))')} as named from (select book, seq, title, page, kind, start, n, {strip('substring(title, 1, start)')} as before, rest "
        f"from (select *, {label('title', 2)} as kind, length({label('title', 1)}) as start, {ordinal(label('title', 3))} as n, {strip(label('title', 4))} as rest from entries)))",
    ),
    "outline": (
        ("roles",),
        'select book, seq, role, o as "order", shown as title, page, chapter_seq, case when role <> \'chapter\' then nullif(lesson_seq, -1) end as lesson_seq from (select *, '
        f"last_value(case when role = 'chapter' then seq end ignore nulls) over ({_BEFORE}) as chapter_seq, "
        f"last_value(case when role = 'chapter' then -1 when role = 'lesson' then seq end ignore nulls) over ({_BEFORE}) as lesson_seq from roles) "
        "where chapter_seq is not null and (role <> 'subtopic' or lesson_seq >= 0)",
    ),
    "printed": (
        ("outline",),
        f"select book, case when role = 'chapter' then '{CHAPTER}' else '{LESSON}' end as kind, \"order\" as o, arg_max(page, seq) as printed from outline where role <> 'subtopic' and page is not null group by 1, 2, 3",
    ),
    "offsets": (
        ("label_blocks", "printed"),
        "select book, off as \"offset\" from (select book, off, row_number() over (partition by book order by count(*) desc, min(page * 1000 + block_index)) as rn from "
        f"(select b.book, b.page, b.block_index, b.page - p.printed as off from (select *, {label('text', 2)} as kind, {ordinal(label('text', 3))} as o from label_blocks where type = 'heading') b join printed p on b.book = p.book and b.kind = p.kind and b.o = p.o) group by book, off) where rn = 1",
    ),
    "book_counts": (("book_pages",), "select book, count(*) as total_pages from book_pages group by 1"),
    "ranges": (
        ("outline", "offsets", "book_counts"),
        'select book, seq, "order", title, chapter_seq, start_page, least(greatest(coalesce(after, total_pages), start_page), total_pages) as end_page from (select o.*, total_pages, greatest(o.page + "offset", 1) as start_page, '
        'lead(o.page) over (partition by o.book order by o.seq) + "offset" - 1 as after from outline o join offsets using (book) join book_counts using (book) where role = \'lesson\' and o.page is not null)',
    ),
    "extracts": (
        ("ranges", "book_pages"),
        "select r.book, r.seq, coalesce(string_agg(p.text, '\n\n' order by p.page) filter (where p.text <> ''), '') as text, count(p.page) as n_pages, min(p.page) as first_page, max(p.page) as last_page "
        "from ranges r left join book_pages p on p.book = r.book and p.page between r.start_page and r.end_page group by 1, 2",
    ),
    "concepts": (
        ("responses",),
        "select book, lesson_order, pos, c.id as slug, concat('lesson-', lesson_order, ':', c.id) as id, c.title as title, coalesce(nullif(c.confidence_score, 0e0), 0.7e0) as confidence from "
        "(select book, lesson_order, generate_subscripts(a, 1) - 1 as pos, unnest(a) as c from (select book, lesson_order, json_transform(response, '{\"concepts\": [{\"id\": \"VARCHAR\", \"title\": \"VARCHAR\", \"confidence_score\": \"DOUBLE\"}]}').concepts as a from responses)) "
        "where coalesce(c.id, '') <> '' and coalesce(c.title, '') <> ''",
    ),
    "edges": (
        ("responses", "concepts"),
        "select book, lesson_order, concat('lesson-', lesson_order, ':rel-', pos + 1) as id, concat('lesson-', lesson_order, ':', e.source_concept_id) as source_id, concat('lesson-', lesson_order, ':', e.target_concept_id) as target_id, "
        "e.relation_type as type from (select book, lesson_order, generate_subscripts(a, 1) - 1 as pos, unnest(a) as e from (select book, lesson_order, json_transform(response, '{\"relationships\": [{\"source_concept_id\": \"VARCHAR\", "
        f"\"target_concept_id\": \"VARCHAR\", \"relation_type\": \"VARCHAR\"}}]}}').relationships as a from responses)) x where e.relation_type in ({quoted(RELATION_TYPES)}) "
        "and exists (select 1 from concepts c where c.book = x.book and c.lesson_order = x.lesson_order and c.slug = e.source_concept_id) and exists (select 1 from concepts c where c.book = x.book and c.lesson_order = x.lesson_order and c.slug = e.target_concept_id)",
    ),
    "resolved": (
        ("requests", "sidecars"),
        "select r.book, r.filename, coalesce(nullif(r.title, ''), nullif(s.book_title, ''), regexp_replace(regexp_replace(r.filename, '^.*/', ''), '^(.+)\\.[^.]*$', '\\1')) as title, "
        "coalesce(nullif(r.course, ''), nullif(s.course, '')) as course, coalesce(nullif(r.grade, ''), nullif(s.grade, '')) as grade from requests r left join sidecars s using (book)",
    ),
    "checked": (
        ("resolved",),
        "select *, case when not lower(filename) like '%.pdf' then 'unsupported_type' when regexp_matches(coalesce(title, ''), '\\?{2,}') or regexp_matches(coalesce(course, ''), '\\?{2,}') or regexp_matches(coalesce(grade, ''), '\\?{2,}') "
        "then 'suspicious_encoding' end as error from resolved",
    ),
    "positions": (("jobs",), "select id, count(*) over (order by created_at range between unbounded preceding and current row) as position from jobs where state = 'queued'"),
    "md_rows": (("accepted",), "select book, page, table_no, rows, list_max(list_transform(rows, lambda r: len(r))) as w from accepted"),
}

#: The same chain from tables to blocks over the lines and tables of whole books.
_CHAIN = {"cells": "page_cells", "cell_lines": "classified"} | {k: f"book_{k}" for k in ("table_rows", "tables", "accepted", "labelled", "outside", "items", "islands", "blocks", "md_rows")}


def _over_books(sql: str) -> str:
    return re.sub(r"\b(from|join) (\w+)\b", lambda m: f"{m[1]} {_CHAIN.get(m[2], m[2])}", sql)


TABLES |= {_CHAIN[k]: (tuple(_CHAIN.get(n, n) for n in TABLES[k][0]), _over_books(TABLES[k][1])) for k in _CHAIN if k in TABLES and k not in ("cells", "cell_lines")}
TABLES["page_blocks"] = (
    ("book_blocks", "page_status"),
    "select b.* from book_blocks b join page_status s using (book, page) where s.method = 'pdfplumber_positional' and not contains(s.warnings, 'BLOCK_STRUCTURING_FAILED') "
    "union all by name select book, page, 1::bigint as block_index, concat(page, '-1') as id, 'paragraph' as type, text, 'ocr_fallback' as source from page_status where method = 'ocr_tesseract' and text <> ''",
)

CAPTION_KEY = "case lower(" + strip("split_part(line, ':', 1)") + ") " + " ".join(f"when '{k}' then '{v}'" for v, ks in CAPTION_KEYS.items() for k in ks.split()) + " end"
LINE = _LINE
ROLE_COUNTS = ", ".join(f"count(*) filter (where role = '{r}') as {r}s" for r in ("chapter", "lesson", "subtopic"))
STATE_LABEL = "case state " + " ".join(f"when '{k}' then '{v}'" for k, v in STATES.items()) + " end"
IN_TERMINAL = "state in ('completed', 'failed', 'cancelled')"
IN_RUNNING = "state in ('downloading', 'ready', 'processing', 'extracting', 'ocr', 'exporting', 'cancel_requested')"


def query(select: str, *needed: str) -> str:
    return with_tables(select, TABLES, *needed)

"""Scalar columns: text cleaning, names, captions, dates, numbers and ratios.

All are Catalyst expressions. White space is Unicode white space throughout; Java's `\\s` is ASCII
without the (?U) flag, and trim() strips spaces only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"(?U)\s+"
#: Characters that render as nothing, control characters among them, and spaces that are not U+0020.
INVISIBLE = r"[\u200b-\u200d\ufeff\x00-\x08\x0b\x0c\x0e-\x1f]"
WIDE_SPACE = r"[\u00a0\u3000]"
#: A unit caption, a number in a cell, a footnote's first character, and what shows that a text tells its unit.
UNIT_CAPTION = r"(?U)\(\s*단\s*위\s*[:：]\s*([^)]*)\)"
NUMBER = r"^-?[0-9,]+(?:\.[0-9]+)?$"
FOOTNOTE = r"(?U)^\s*[※*＊]"
UNIT_ANYWHERE = r"(?U)단\s*위\s*[:：]|\(단위|\(원\)|\(주\)|\(%\)|백만원|천원|억원|만원|조원|원\)|주\)|％|%\)|미\s*달러|USD|천주|백만주"
#: A period's number, the whole label with what may follow it in running text, and a date.
PERIOD = r"제\s*[0-9]{1,3}\s*기"
PERIOD_LABEL = PERIOD + r"(?:\s*[0-9]{1,2}\s*분기|\s*반기)?(?:\s*(?:기말|기초|말|초))?(?:\s*(?:누적|[0-9]{1,2}\s*개월))?"
DATE = r"[0-9]{4}[.\-/년]\s*[0-9]{1,2}[.\-/월]\s*[0-9]{1,2}"
#: Cells that stand for "nothing here".
EMPTY_VALUES = ("-", "–", "—", "", ".", "·")
#: Legal forms that are no part of a company's bare name.
LEGAL_FORMS = r"(?i)\(주\)|㈜|주식회사|\(유\)|유한회사|,?\s*co\.,?\s*ltd\.?|,?\s*inc\.|,?\s*corp\.(?=\s|$)"
#: The named entities of the filings; the ampersand is decoded last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean(text: Column) -> Column:
    """Wide spaces become spaces, invisible characters go, runs of blanks become one, lines are trimmed and blank lines dropped."""
    plain = F.regexp_replace(F.regexp_replace(text, WIDE_SPACE, " "), INVISIBLE, "")
    lines = F.transform(F.split(plain, "\n"), lambda x: strip(F.regexp_replace(x, r"[ \t]{2,}", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def flat(text: Column) -> Column:
    """clean() on one line."""
    return strip(F.regexp_replace(F.regexp_replace(clean(text), "\n", " "), r"[ \t]{2,}", " "))


def escape_cell(text: Column, line_break: str = "<br>", trim: bool = True) -> Column:
    """Text for a Markdown table cell."""
    out = F.regexp_replace(F.regexp_replace(text, r"\|", r"\\|"), "\r?\n", line_break)
    return strip(out) if trim else out


def without_blanks(text: Column) -> Column:
    """Text without white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def normal_lines(text: Column) -> Column:
    lines = F.transform(F.split(text, "\r?\n"), lambda x: strip(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def decode_entities(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), text)


def strip_tags(markup: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(markup, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", ""), r"<[^>]*>", " ")


def bare_ampersands(markup: Column) -> Column:
    """Ampersands that begin no entity."""
    return F.regexp_count(markup, F.lit("&")) - F.regexp_count(markup, F.lit(r"&(amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);"))


def strip_legal_form(name: Column) -> Column:
    return strip(F.regexp_replace(name, LEGAL_FORMS, ""))


def alias_candidates(corp: Column, *others: Column) -> Column:
    """Ordered distinct names under which a company may be written."""
    bare = strip_legal_form(corp)
    found = F.array(F.concat(F.lit("(주)"), bare), F.concat(bare, F.lit("주식회사")), *others, corp, bare)
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (strip(x) != "")))


def safe_filename(name: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(name, r'[\\/:*?"<>|\x00-\x1f]', "_"), r"^[ .]+|[ .]+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", F.lit("_")).otherwise(out)


def normal_label(label: Column) -> Column:
    """A row label without spaces, a note reference at its end, and numbering at its beginning."""
    out = F.regexp_replace(without_blanks(label), r"\(주[0-9][^)]*\)$", "")
    return F.regexp_replace(out, r"^(?:(?:[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩIVXivx]{1,5}|[0-9]{1,2}|[가-힣])[.)]){1,3}", "")


def caption_unit(text: Column) -> Column:
    """X of `(단위 : X)`, which may be empty; null without it."""
    return F.when(text.rlike(UNIT_CAPTION), strip(F.regexp_extract(text, UNIT_CAPTION, 1)))


def caption_kind(text: Column) -> Column:
    """unit, footnote or null; unit wins."""
    return F.when(text.rlike(r"(?U)\(\s*단\s*위\s*[:：]"), "unit").when(text.rlike(FOOTNOTE), "footnote")


def statement_code(code: Column) -> Column:
    """Statement, basis, where the basis is from, and variant of a code such as {XBRL}IS_C3 or {XBRL}IS1; null for others."""
    part = lambda k: F.nullif(F.regexp_extract(strip(code), r"^\{XBRL\}(BS|IS|CF|EF)(?:_([SC]))?([0-9])?$", k), F.lit(""))
    basis = F.when(part(2) == "S", "separate").otherwise("consolidated")
    source = F.when(part(2).isNull(), "inferred_no_suffix").otherwise("suffix")
    return F.when(part(1).isNotNull(), F.struct(part(1).alias("statement"), basis.alias("basis"), part(3).cast("int").alias("variant"), source.alias("basis_source")))


def empty_value(text: Column) -> Column:
    return strip(text).isin(*EMPTY_VALUES)


def number(text: Column) -> Column:
    """1,234, -5.5 and (1,234) as doubles; null for anything else."""
    plain = F.replace(strip(text), F.lit(" "), F.lit(""))
    negative = plain.startswith("(") & plain.endswith(")")
    inner = F.when(negative, F.regexp_replace(plain, r"^\(|\)$", "")).otherwise(plain)
    found = F.when(inner.rlike(NUMBER), F.replace(inner, F.lit(","), F.lit("")).try_cast("double"))
    return F.when(negative, -found).otherwise(found)


def whole(text: Column, default: int) -> Column:
    return F.coalesce(strip(text).try_cast("int"), F.lit(default))


def iso_parts(y: Column, m: Column, d: Column) -> Column:
    """Zero-padded, with no check of the calendar."""
    return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))


def iso_digits(text: Column) -> Column:
    """yyyymmdd as yyyy-mm-dd; other text as it is; blank is null."""
    t = strip(text)
    return F.when(t.rlike(r"^\d{8}$"), F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")).when(t != "", t)


def unit_value_dates(text: Column) -> Column:
    """yyyymmdd, or yyyymmdd-yyyymmdd as `a ~ b`; null for others."""
    return F.when(text.rlike(r"^\d{8}$"), iso_digits(text)).when(text.rlike(r"^\d{8}-\d{8}$"), F.concat(iso_digits(F.substring(text, 1, 8)), F.lit(" ~ "), iso_digits(F.substring(text, 10, 8))))


def dates_in(text: Column) -> Column:
    """ISO dates for every 2023.03.31, 2023-3-31 or 2023년 3월 31일 of a text."""
    found = F.regexp_extract_all(text, F.lit(f"(?U)({DATE})"), F.lit(1))
    return F.transform(found, lambda x: iso_parts(F.regexp_extract(x, r"^([0-9]{4})", 1), F.regexp_extract(x, r"^[0-9]{4}[^0-9]+([0-9]{1,2})", 1), F.regexp_extract(x, r"([0-9]{1,2})$", 1)))


def period_of(text: Column) -> Column:
    """kind (duration, instant, unknown) with begin and end: two dates or more, one, none."""
    d = dates_in(text)
    kind = F.when(F.size(d) >= 2, "duration").when(F.size(d) == 1, "instant").otherwise("unknown")
    return F.struct(kind.alias("kind"), F.get(d, F.lit(0)).alias("begin"), F.when(F.size(d) >= 2, F.get(d, F.lit(1))).alias("end"))


def one_blank(text: Column) -> Column:
    """Trimmed, runs of white space as one space."""
    return strip(F.regexp_replace(text, BLANK, " "))


def period_label(text: Column, caption: bool = False) -> Column:
    """The label of the first period that a text names (`제 N 기` ...): up to the first date behind it, or else as far as a label may go; null without one.

    In a caption without a date the label goes on to the end.
    """
    behind = F.regexp_extract(text, f"(?sU){PERIOD}.*", 0)
    dated = behind.rlike(f"(?U){DATE}")
    plain = behind if caption else F.regexp_extract(behind, f"(?U)^{PERIOD_LABEL}", 0)
    return F.when(behind != "", one_blank(F.when(dated, F.regexp_extract(behind, f"(?sU)^(.*?){DATE}", 1)).otherwise(plain)))


def period_labels(text: Column) -> Column:
    """All labels that a text names, in order, each as far as a label may go."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?U)({PERIOD_LABEL})"), F.lit(1)), lambda x: F.regexp_replace(x, BLANK, " "))


def period_display(period: Column) -> Column:
    return F.when(period["kind"] == "duration", F.concat(period["begin"], F.lit(" ~ "), period["end"])).when(period["kind"] == "instant", period["begin"])


def receipt_year(receipt: Column) -> Column:
    return F.substring(receipt, 1, 4).try_cast("int")


def short_sha1(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def ratio(part: Column, whole_: Column, digits: int = 4) -> Column:
    """Rounded half to even; null for a zero whole."""
    return F.when(whole_ != 0, F.bround(part / whole_, digits))


def ceil_div(a: Column, b: Column) -> Column:
    return F.floor((a + b - 1) / b).cast("long")


def tokens_estimate(n_bytes: Column, per_token: float = 3.0) -> Column:
    return F.ceil(n_bytes / per_token).cast("long")


def human_size(n: Column) -> Column:
    return F.when(n >= 1e9, F.concat(F.format_number(n / 1e9, 2), F.lit(" GB"))).otherwise(F.concat(F.format_number(n / 1e6, 1), F.lit(" MB")))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def coverage_tokens(text: Column) -> Column:
    """Distinct Hangul runs of three letters and more, and Latin or digit runs of three and more."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"([가-힣]{3,}|[A-Za-z0-9][A-Za-z0-9.\-]{2,})"), F.lit(1)))


def truncate(text: Column, cap: int, mark: str = "…") -> Column:
    return F.when(F.length(text) > cap, F.concat(F.substring(text, 1, cap), F.lit(mark))).otherwise(text)


def context_header(corp: Column, report: Column, date: Column, path: Column, unit: Column | None = None, dates: Column | None = None, extra: Column | None = None) -> Column:
    """Lines that make a chunk stand alone: who, what and when; the section path; the unit; periods (label, shown) with their dates; a note."""
    filled = lambda c: F.nullif(c, F.lit(""))
    who = filled(F.concat_ws(" · ", filled(corp), filled(report), filled(date)))
    lines = [F.concat(F.lit("["), who, F.lit("]")), F.when(F.size(path) > 0, F.concat(F.lit("> "), F.array_join(path, " > ")))]
    if unit is not None:
        lines.append(F.concat(F.lit("(단위: "), filled(unit), F.lit(")")))
    if dates is not None:
        lines.append(F.when(F.size(dates) > 0, F.concat(F.lit("("), F.array_join(F.transform(dates, lambda x: F.concat(x["label"], F.lit(" = "), x["shown"])), " · "), F.lit(")"))))
    if extra is not None:
        lines.append(extra)
    return F.concat_ws("\n", *lines)


def kv_line(keys: Column, value: Column) -> Column:
    """`a > b: value`; a null value is shown as not applicable."""
    return F.concat(F.array_join(keys, " > "), F.lit(": "), F.coalesce(value, F.lit("(해당없음)")))


def config_hash(*parts: Column) -> Column:
    return F.substring(F.sha2(F.to_json(F.struct(*parts)), 256), 1, 16)

"""Tables as arrays of rows: shape, header band, columns, captions and their tables, statement groups, PDF tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.scalars import PERIOD, caption_kind, caption_unit, empty_value, number, period_label, period_of, statement_code, without_blanks

from .windows import attach_direction


def shape(rows: Column) -> Column:
    """Rows and the widest row's cells."""
    return F.struct(F.size(rows).alias("n_rows"), F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0)).alias("n_cols"))


def verdict(rows: Column) -> Column:
    """empty, not_a_table (one row or one column) or real_table."""
    s = shape(rows)
    return F.when((s["n_rows"] == 0) | (s["n_cols"] == 0), "empty").when((s["n_rows"] > 1) & (s["n_cols"] > 1), "real_table").otherwise("not_a_table")


def numeric_row(row: Column) -> Column:
    """Any cell but the first is a number."""
    return F.exists(F.slice(row, F.lit(2), F.greatest(F.size(row) - 1, F.lit(0))), lambda c: number(c).isNotNull())


def header_rows(rows: Column, marked: Column | None = None) -> Column:
    """How many rows the header has: leading marked rows (three at most, and not all), else the rows before the first with a number."""
    first = F.array_position(F.transform(rows, numeric_row), F.lit(True)).cast("int") - 1
    by_numbers = F.when(first < 0, 0).otherwise(first)
    if marked is None:
        return by_numbers
    lead = F.coalesce(F.nullif(F.array_position(marked, F.lit(False)).cast("int") - 1, F.lit(-1)), F.size(marked))
    return F.when(lead == F.size(rows), 0).when(lead > 0, F.least(lead, F.lit(3))).otherwise(by_numbers)


def merged_header(rows: Column, n: Column) -> Column:
    """The first n rows merged by column: a part is added if the name has it not yet."""
    width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))
    top = F.slice(rows, F.lit(1), n)
    add = lambda name, part: F.when((F.coalesce(part, F.lit("")) == "") | F.contains(name, part), name).when(name == "", part).otherwise(F.concat(name, F.lit(" "), part))
    return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda c: F.aggregate(F.transform(top, lambda r: F.get(r, c)), F.lit(""), add))).otherwise(F.array().cast("array<string>"))


def body(rows: Column, n: Column) -> Column:
    """The rows behind the header that are not blank."""
    return F.filter(F.slice(rows, n + 1, F.greatest(F.size(rows) - n, F.lit(0))), lambda r: F.exists(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))


def live_columns(rows: Column) -> Column:
    """The rows without the columns that equal their left neighbour in every row, as spans leave them."""
    width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))
    kept = F.filter(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda c: (c == 0) | F.exists(rows, lambda r: ~F.get(r, c).eqNullSafe(F.get(r, c - 1))))
    return F.transform(rows, lambda r: F.transform(kept, lambda c: F.get(r, c)))


def numeric_table(rows: Column) -> Column:
    """Half or more of the cells with something are numbers."""
    cells = F.filter(F.flatten(rows), lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")
    return (F.size(cells) > 0) & (2 * F.size(F.filter(cells, lambda c: number(c).isNotNull())) >= F.size(cells))


def judge_captions(tables: DataFrame, parent: list[str], order: str) -> DataFrame:
    """Tables among their siblings, with a caption's kind and the direction in which it is attached.

    tables: parent, order, text (of a table that is none), rows.
    """
    w = Window.partitionBy(*parent).orderBy(order)
    df = tables.withColumn("judged", verdict(F.col("rows")))
    real = F.coalesce(F.col("judged") == "real_table", F.lit(False))
    df = df.withColumn("before_real", F.coalesce(F.lag(real).over(w), F.lit(False))).withColumn("after_real", F.coalesce(F.lead(real).over(w), F.lit(False)))
    kind = F.when(F.col("judged") == "not_a_table", caption_kind(F.col("text")))
    return df.withColumn("caption", kind).withColumn("attach", attach_direction(F.col("caption"), F.col("before_real"), F.col("after_real"))).withColumn("unit", F.when(F.col("caption") == "unit", caption_unit(F.col("text"))))


def caption_census(judged: DataFrame, by: list[str]) -> DataFrame:
    """How captions stand among tables, by kind."""
    b, a = F.col("before_real"), F.col("after_real")
    return judged.filter("caption is not null").groupBy(*by, "caption").agg(
        F.count("*").alias("total"), F.count_if(a & ~b).alias("next_only"), F.count_if(b & ~a).alias("prev_only"), F.count_if(a & b).alias("both"), F.count_if(~a & ~b).alias("neither"), F.count("attach").alias("attached")
    )


def invariants(judged: DataFrame, key: list[str]) -> DataFrame:
    """Attachments that point at no table."""
    bad = ((F.col("attach") == "next") & ~F.col("after_real")) | ((F.col("attach") == "prev") & ~F.col("before_real"))
    return judged.filter(bad).select(*key, "attach")


def statement_groups(tables: DataFrame, group: list[str], order: str, code: str) -> DataFrame:
    """Tagged groups of tables: captions are those of one column, data the last of several; periods from the captions; low confidence without data.

    tables: group, order, code, rows.
    """
    wide = shape(F.col("rows"))["n_cols"] > 1
    lines = F.when(~wide, F.transform("rows", lambda r: F.array_join(r, " ")))
    g = tables.filter(statement_code(F.col(code)).isNotNull()).groupBy(*group, code).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(~wide, F.struct(order, lines.alias("l"))))), lambda x: x["l"])).alias("captions"), F.max_by("rows", F.when(wide, F.col(order))).alias("data"))
    s = statement_code(F.col(code))
    unit = F.get(F.filter(F.transform("captions", caption_unit), lambda u: u.isNotNull()), F.lit(0))
    return g.select(*group, code, s["statement"].alias("statement"), s["basis"].alias("basis"), s["variant"].alias("variant"), "captions", unit.alias("unit"), caption_periods(F.col("captions")).alias("periods"), merged_header(F.col("data"), header_rows(F.col("data"))).alias("header"), body(F.col("data"), header_rows(F.col("data"))).alias("rows"), F.when(F.col("data").isNull(), "low").otherwise("unverified").alias("parse_confidence"))


def caption_periods(captions: Column) -> Column:
    """The captions that name a period: label, kind, begin and end (kind unknown without a date)."""
    named = F.transform(captions, lambda c: F.struct(period_label(c, caption=True).alias("label"), period_of(c).alias("p")))
    return F.transform(F.filter(named, lambda x: x["label"].isNotNull()), lambda x: F.struct(x["label"].alias("label"), x["p"]["kind"].alias("kind"), x["p"]["begin"].alias("begin"), x["p"]["end"].alias("end")))


def column_periods(header: Column, periods: Column) -> Column:
    """For each column its header, the period whose label is the longest that the header begins with, blanks aside, and what the header has more (`qualifier`)."""

    def one(h: Column, i: Column) -> Column:
        key = without_blanks(h)
        met = F.filter(F.transform(periods, lambda p: F.struct(F.length(without_blanks(p["label"])).alias("n"), p.alias("p"))), lambda x: (x["n"] > 0) & F.startswith(key, without_blanks(x["p"]["label"])))
        best = F.get(F.filter(met, lambda x: x["n"] == F.array_max(F.transform(met, lambda y: y["n"]))), F.lit(0))  # the first of equals
        return F.struct(i.alias("index"), h.alias("header"), best["p"].alias("period"), F.nullif(F.substring(key, best["n"] + 1, F.length(key)), F.lit("")).alias("qualifier"))

    return F.transform(header, one)


def header_cell(text: Column) -> Column:
    """Of a PDF's cell, whether it may head a column: a label, a bare year, or a period's number."""
    year = text.rlike(r"(?U)^(19|20)[0-9]{2}\s*년?\s*([0-9]{1,2}\s*월)?$")
    return ~value_cell(text) | year | text.rlike(f"(?U)^{PERIOD}")


def shaded_header(tags: Column, marks: Column, n_rows: Column) -> Column:
    """Whether a table's first row is its header by its shading: all its cells are plain and marked BC0..., and rows follow."""
    shaded = F.zip_with(tags, marks, lambda t, m: (F.lower(t) == "td") & F.startswith(F.upper(F.coalesce(m, F.lit(""))), F.lit("BC0")))
    return (n_rows > 1) & (F.size(tags) > 0) & F.forall(shaded, lambda x: x)


def value_cell(text: Column) -> Column:
    """Of a PDF's cell: a dash, a mark, a date or a number is a value, other text a label."""
    return empty_value(text) | text.rlike(r"^[○●□■√✓VvOX]$") | text.rlike(r"^\d{4}[.\-/년]") | number(F.regexp_replace(text, r"^[△▲]", "")).isNotNull()


def pdf_blocks(tables: DataFrame, rows: str = "rows") -> DataFrame:
    """Adds kind: kv for two columns at most, or for three or four without neighbouring values in a row; else table; paragraph for one cell."""
    s, cells = shape(F.col(rows)), F.col(rows)
    neighbours = F.exists(cells, lambda r: F.exists(F.zip_with(F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), lambda a, b: value_cell(a) & value_cell(b)), lambda x: F.coalesce(x, F.lit(False))))
    kind = F.when((s["n_rows"] == 1) & (s["n_cols"] == 1), "p").when(s["n_cols"] <= 2, "kv").when((s["n_cols"] <= 4) & ~neighbours, "kv").otherwise("t")
    return tables.withColumn("kind", kind)


def sections(blocks: DataFrame, part: str) -> DataFrame:
    """Notices by section: title, keyed fields in order and notes; sections with neither go."""
    w = Window.partitionBy(part).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    df = blocks.withColumn("section", F.count_if(F.col("kind") == "h").over(w))
    field = F.when(F.col("kind") == "kv", F.struct("seq", F.array_join("keys", " > ").alias("field"), "value"))
    note = F.when(F.col("kind") == "p", F.struct("seq", "text"))
    g = df.groupBy(part, "section").agg(F.min_by("text", F.when(F.col("kind") == "h", F.col("seq"))).alias("title"), F.transform(F.array_sort(F.collect_list(field)), lambda x: F.struct(x["field"].alias("field"), x["value"].alias("value"))).alias("fields"), F.transform(F.array_sort(F.collect_list(note)), lambda x: x["text"]).alias("notes"))
    return g.filter((F.size("fields") > 0) | (F.size("notes") > 0))

"""Documents as wholes: index rows, period dictionaries, Markdown, diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.scalars import dates_in, escape_cell, kv_line, period_label, period_labels, period_of, without_blanks

from .windows import first_wins


def document_index(manifest: DataFrame, blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each manifest row: status, headings of level two in order and distinct, counts of blocks and tables. Figures that were not taken are null."""
    h = F.when((F.col("kind") == "h") & (F.col("level") == 2), F.struct("seq", "text"))
    found = blocks.groupBy(key).agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(h)), lambda x: x["text"])).alias("toc"), F.count("*").alias("n_blocks"), F.count_if(F.col("kind") == "t").alias("n_tables")
    )
    return manifest.join(found, key, "left").withColumn("status", F.when(F.col("n_blocks").isNull(), "no_source").otherwise("ok"))


def period_dictionary(blocks: DataFrame, key: str, text: Column) -> DataFrame:
    """For each document and period label: occurrences, the period, the dated label it is from, what the label has more than that (`qualifier`), and whether it is resolved.

    blocks: rows of lines with `seq`. Periods are those of labels on one line with a date, the first of
    each label. A label without an own date has that of the longest dated label that it begins with.
    """
    lines = blocks.select(key, "seq", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    place = F.struct("seq", "line_no")
    dated = lines.select(key, place.alias("place"), period_label(F.col("line"), caption=True).alias("dated_label"), period_of(F.col("line")).alias("period")).filter("dated_label is not null and period.kind != 'unknown'")
    dated = first_wins(dated.withColumn("dated_key", without_blanks(F.col("dated_label"))), [key, "dated_key"], ["place"]).filter("dated_key != ''")
    named = blocks.select(key, "seq", F.posexplode(period_labels(text)).alias("pos", "label")).withColumn("label_key", without_blanks(F.col("label")))
    labels = named.groupBy(key, "label_key").agg(F.count("*").alias("n"), F.min(F.struct("seq", "pos", "label")).alias("first"))
    met = labels.join(dated, key).filter(F.startswith(F.col("label_key"), F.col("dated_key")))
    best = met.groupBy(key, "label_key").agg(F.max_by(F.struct("period", "dated_label", F.substring("label_key", F.length("dated_key") + 1, F.length("label_key")).alias("qualifier")), F.length("dated_key")).alias("b"))
    found = labels.join(best, [key, "label_key"], "left")
    return found.select(key, F.col("first.label").alias("label"), F.struct("first.seq", "first.pos").alias("place"), "n", "b.period", F.col("b.dated_label").alias("matched"), F.nullif("b.qualifier", F.lit("")).alias("qualifier"), F.col("b").isNotNull().alias("resolved"))


def ungrounded_dates(periods: DataFrame, bodies: DataFrame, key: str, text: str) -> DataFrame:
    """Dates of periods that the document's text does not have."""
    said = periods.groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array("period.begin", "period.end"))))).alias("said"))
    own = bodies.select(key, F.array_distinct(dates_in(F.col(text))).alias("own"))
    return said.join(own, key, "left").select(key, F.explode(F.array_except("said", F.coalesce("own", F.array().cast("array<string>")))).alias("date"))


def block_markdown() -> Column:
    """A block as Markdown."""
    line = lambda cells, n: F.concat(F.lit("| "), F.array_join(F.transform(F.slice(F.concat(cells, F.array_repeat(F.lit(""), n)), F.lit(1), n), lambda c: escape_cell(F.coalesce(c, F.lit("")))), " | "), F.lit(" |"))
    n = F.when(F.size("headers") > 0, F.size("headers")).otherwise(F.array_max(F.transform("rows", lambda r: F.size(r))))
    head = F.when(F.size("headers") > 0, line(F.col("headers"), n)).otherwise(F.concat(F.repeat(F.lit("|  "), n), F.lit("|")))
    table = F.concat_ws("\n", head, F.concat(F.repeat(F.lit("|---"), n), F.lit("|")), F.array_join(F.transform("rows", lambda r: line(r, n)), "\n"))
    title = F.concat(F.repeat(F.lit("#"), F.least(F.col("level"), F.lit(6))), F.lit(" "), F.col("text"))
    return F.when(F.col("kind") == "h", title).when(F.col("kind") == "kv", F.concat(F.lit("- "), kv_line(F.col("keys"), F.col("value")))).when(F.col("kind") == "t", table).otherwise(F.col("text"))


def markdown(blocks: DataFrame, key: str, header: DataFrame | None = None) -> DataFrame:
    """One Markdown text for each document: header, a blank line, and the blocks, with a newline at the end."""
    body = blocks.select(key, "seq", block_markdown().alias("m")).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "m"))), lambda x: x["m"]), "\n\n").alias("body"))
    if header is None:
        return body.select(key, F.concat("body", F.lit("\n")).alias("markdown"))
    return body.join(header, key, "left").select(key, F.concat(F.concat_ws("\n\n", "header", "body"), F.lit("\n")).alias("markdown"))


#: The version of the envelope.
SCHEMA = "document/1"
ENVELOPE = ("doc_id", "doc_group", "corp_code", "corp_name", "rcept_no", "rcept_dt", "report_nm", "is_correction")


def envelope(manifest: DataFrame, parts: DataFrame) -> DataFrame:
    """A row for each document: schema, ENVELOPE, n_parts, and its parts (part_key, doc) in order of their keys."""
    own = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("part_key", "doc"))).alias("parts"))  # a document's files
    rows = manifest.select(*ENVELOPE).join(own, "doc_id", "left").withColumn("parts", F.coalesce("parts", F.array()))
    return rows.select(F.lit(SCHEMA).alias("schema"), *ENVELOPE, F.size("parts").alias("n_parts"), "parts")


def part_doc(parts: Column, key: Column) -> Column:
    """The document of one part of an envelope; null without it."""
    return F.get(F.filter(parts, lambda p: p["part_key"] == key), F.lit(0))["doc"]


def placeholders(manifest: DataFrame) -> DataFrame:
    """Blocks for documents whose files are no markup: a heading and a line that says that their text was not taken."""
    rows = manifest.filter(F.lower("file_format") != "xml")
    title = F.concat_ws(" · ", F.nullif("corp_name", F.lit("")), F.nullif("report_nm", F.lit("")))
    block = lambda seq, kind, level, text: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), F.lit(level).cast("int").alias("level"), text.alias("text"))
    each = F.array(block(0, "h", 1, title), block(1, "p", None, F.concat(F.lit("pdf_only_no_text_extraction: "), F.coalesce("file_path", F.lit("")))))
    return rows.select("doc_id", F.explode(each).alias("b")).select("doc_id", "b.*")


def worker_totals(stats: DataFrame) -> DataFrame:
    """One row of several workers' figures: the longest time, the summed rate, what was skipped."""
    return stats.agg(F.count("*").alias("n_workers"), F.max("seconds").alias("wall_seconds"), F.round(F.sum(F.coalesce("chunks_per_sec", F.lit(0.0))), 2).alias("chunks_per_sec"), F.sum("n_skipped").alias("n_skipped"))


def rag_header(corp: Column, report: Column, date: Column, aliases: Column) -> Column:
    """Three lines: the company and report, the date, other names."""
    blank = lambda c, default: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))
    return F.concat_ws("\n", F.concat(F.lit("# "), blank(corp, "미상"), F.lit(" · "), blank(report, "미상")), F.concat(F.lit("접수일: "), blank(date, "미상")), F.concat(F.lit("별칭: "), F.array_join(aliases, ", ")))


def diagnostics(sources: DataFrame, blocks: DataFrame, key: str, text: str) -> DataFrame:
    """Share of Hangul in the source, tables with rows of several widths, and blocks by kind."""
    letters = F.regexp_count(text, F.lit(r"\S"))
    own = sources.select(key, F.when(letters > 0, F.bround(F.regexp_count(text, F.lit("[가-힣]")) / letters, 4)).alias("hangul_ratio"))
    ragged = (F.col("kind") == "t") & (F.size(F.array_distinct(F.transform("rows", lambda r: F.size(r)))) > 1)
    found = blocks.groupBy(key).agg(F.count_if(ragged).alias("n_ragged"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("h", "p", "kv", "t")])
    return own.join(found, key, "left")


def structural_loss(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Documents that lost tables between two stages, the worst first within each."""
    a, b = (d.groupBy(key).agg(F.count_if(F.col("kind") == "t").alias(n)) for d, n in ((before, "n_before"), (after, "n_after")))
    return a.join(b, key, "left").withColumn("lost", F.col("n_before") - F.coalesce("n_after", F.lit(0))).filter("lost > 0")


def worst(df: DataFrame, by: list[str], measure: str, n: int, key: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(measure), key)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def block_text() -> Column:
    """All text of a block, by spaces."""
    rows = F.array_join(F.flatten(F.coalesce("rows", F.array().cast("array<array<string>>"))), " ")
    return F.trim(F.concat_ws(" ", "text", F.array_join(F.coalesce("keys", F.array().cast("array<string>")), " "), "value", F.array_join(F.coalesce("headers", F.array().cast("array<string>")), " "), rows))


def value_set(blocks: DataFrame, key: str) -> DataFrame:
    """key and the distinct values that a document states: cells, keys and values, each also without a date in parentheses behind it."""
    own = F.concat(F.flatten(F.coalesce("rows", F.array().cast("array<array<string>>"))), F.coalesce("keys", F.array().cast("array<string>")), F.array_compact(F.array("value")))
    each = blocks.select(key, F.explode(own).alias("value")).filter("value is not null and trim(value) != ''")
    bare = each.withColumn("value", F.regexp_replace("value", r"\s*\(\d{4}-\d{2}-\d{2}(?: ~ \d{4}-\d{2}-\d{2})?\)$", ""))
    return each.union(bare).distinct()


def with_iso(text: Column, iso: Column) -> Column:
    """`text (iso)`, unless the text has it already."""
    return F.when(iso.isNull() | F.contains(text, iso), text).otherwise(F.concat(text, F.lit(" ("), iso, F.lit(")")))


def markdown_name(corp: Column, doc_id: Column, suffix: Column) -> Column:
    from docloom.functions.scalars import safe_filename

    return F.concat(safe_filename(corp), F.lit("_"), doc_id, F.coalesce(suffix, F.lit("")), F.lit(".md"))


def old_name(filer: Column, corp: Column) -> Column:
    """The filer's name if it differs from the company's, legal forms aside."""
    from docloom.functions.scalars import strip_legal_form

    return F.when((F.trim(filer) != "") & (F.lower(strip_legal_form(filer)) != F.lower(strip_legal_form(corp))), F.trim(filer))


def company_in_markup(source: Column) -> Column:
    """A company name without a parse: the first COMPANY-NAME, else what the title has before its first slash."""
    tag = F.regexp_extract(source, r"(?is)<company-name[^>]*>(.*?)</company-name>", 1)
    title = F.regexp_extract(source, r"(?is)<title[^>]*>([^/<]*)", 1)
    plain = lambda c: F.nullif(F.trim(F.regexp_replace(c, r"<[^>]*>", "")), F.lit(""))
    return F.coalesce(plain(tag), plain(title))


def heading_like(text: Column, bold: Column, centred: Column) -> Column:
    """A paragraph that is a heading: bold, and centred or begun with a bracket."""
    return bold & (centred | F.trim(text).rlike(r"^[【\[]"))


def document_type(headings: Column) -> Column:
    """The first heading that ends in 보고서."""
    return F.get(F.filter(headings, lambda h: F.endswith(F.trim(h), F.lit("보고서"))), F.lit(0))


def cover_pairs(text: Column, pattern: str, names: list[str]) -> Column:
    """A cover page's fields by one pattern's groups in order: all of them, or none."""
    parts = [F.trim(F.regexp_extract(text, pattern, k + 1)) for k in range(len(names))]
    return F.when(text.rlike(pattern), F.array(*[F.struct(F.lit(n).alias("field"), p.alias("value")) for n, p in zip(names, parts, strict=True)]))


def alias_sets(names: DataFrame, key: str, name: str, excluding: str | None = None) -> DataFrame:
    """Sorted distinct names for each company; with `excluding`, without that column's name."""
    rows = names.filter(F.trim(F.coalesce(name, F.lit(""))) != "")
    if excluding:
        rows = rows.filter(~F.col(name).eqNullSafe(F.col(excluding)))
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(name)).alias("aliases"))


def worst_checks(checks: DataFrame, group: list[str]) -> DataFrame:
    """For each group how many checks failed, and the one with the greatest difference."""
    d = F.abs(F.col("total") - F.col("sum"))
    return checks.groupBy(*group).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "fail").alias("failed"), F.max_by("name", d).alias("worst"), F.max(d).alias("difference"))

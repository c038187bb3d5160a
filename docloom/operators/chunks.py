"""Self-contained chunks from typed blocks, with windows over document order.

A chunk is a run of text blocks or a piece of a table. It carries the section path, the unit and the
periods in force where it is emitted, and its text begins with lines that tell them. A unit caption
sets the unit of its section and a table header that of its table; a footnote with nothing but
headings and unit captions between it and the table before is attached to that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.scalars import BLANK, FOOTNOTE, UNIT_ANYWHERE, UNIT_CAPTION, caption_unit, context_header, kv_line, period_labels, strip, without_blanks

from .windows import carried, section_number, section_path, split_rows

#: Rows of a table's piece, and the share of numeric cells from which on a table has to have a unit.
TABLE_ROWS, NUMERIC = 40, 0.2
#: Fixed value: a cell that counts as a number here, of four characters at least.
NUMERIC_CELL = r"^-?\(?[0-9,]{4,}\)?$"
META = ("corp_name", "report_nm", "rcept_dt")


def table_text(headers: Column, rows: Column) -> Column:
    """Rows as Markdown under the header, each as wide as that; without a header as wide as the widest row."""
    n = F.when(F.size(headers) > 0, F.size(headers)).otherwise(F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0)))
    cell = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.slice(F.concat(F.transform(cells, cell), F.array_repeat(F.lit(""), n)), F.lit(1), n), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n), " | "), F.lit(" |"))
    return F.concat_ws("\n", line(headers), rule, F.when(F.size(rows) > 0, F.array_join(F.transform(rows, line), "\n")))


def numeric_share(rows: Column) -> Column:
    """The share of numbers in cells that are not blank; 0 without any."""
    cells = F.filter(F.transform(F.flatten(rows), strip), lambda c: F.coalesce(c, F.lit("")) != "")
    return F.when(F.size(cells) > 0, F.bround(F.size(F.filter(cells, lambda c: c.rlike(NUMERIC_CELL))) / F.size(cells), 3)).otherwise(0.0)


def build_chunks(blocks: DataFrame, part: str, size: int = TABLE_ROWS, meta: DataFrame | None = None, periods: DataFrame | None = None, confidence: DataFrame | None = None) -> DataFrame:
    """Chunks of each part, numbered from 0: part, chunk_id, kind, section_path, unit, unit_source, periods, period_dates, text, n_chars, n_rows, n_cols, numeric_ratio, parse_confidence, unit_known, footnotes.

    blocks: part, seq, kind (h, p, kv, t), level, text, keys, value, headers, rows. meta: part with the
    columns META. periods: part, label, place and period of documents.period_dictionary(). confidence:
    part, place, caption and parse_confidence of statement groups, which tables have whose section
    path holds the caption. unit_known is null where nothing asks for a unit. A part's windows are one
    task's, and sorted there, not held; what a section names is held in one row.
    """
    heading, table = F.col("kind") == "h", F.col("kind") == "t"
    df = blocks.withColumn("headers", F.coalesce("headers", F.array().cast("array<string>"))).withColumn("rows", F.coalesce("rows", F.array().cast("array<array<string>>")))
    df = df.withColumn("section", section_number([part], "seq", heading))
    df = section_path(df, [part], "seq", F.when(heading, F.coalesce("level", F.lit(1))), F.col("text"))
    # what each paragraph is
    text = F.coalesce("text", F.lit(""))
    note = (F.col("kind") == "p") & text.rlike(FOOTNOTE)
    caption = (F.col("kind") == "p") & text.rlike(UNIT_CAPTION)
    bare = caption & (F.regexp_replace(F.regexp_replace(text, UNIT_CAPTION, ""), BLANK, "") == "")
    up_to = Window.partitionBy(part).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(part).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    solid = table | (F.col("kind") == "kv") | ((F.col("kind") == "p") & ~note & ~bare)
    last = F.last(F.when(solid, F.struct("kind", "seq")), True).over(before)
    df = df.withColumn("of_table", F.when(note & (last["kind"] == "t"), last["seq"]))
    attached = F.col("of_table").isNotNull()
    df = df.withColumn("line", F.when(F.col("kind") == "kv", F.concat(F.lit("- "), kv_line(F.col("keys"), F.col("value")))).when((F.col("kind") == "p") & ~attached & ~bare, text))
    df = df.withColumn("unit", carried(F.when(caption & ~attached, caption_unit(text)), [part, "section"], "seq"))
    named = F.when((F.col("kind") == "p") & ~attached & ~caption, period_labels(text)).when(table, F.flatten(F.transform("headers", period_labels)))
    df = df.withColumn("named", named).withColumn("run", F.count_if(heading | table).over(up_to))
    # text is emitted at the heading, table or end behind it, with what holds there
    runs = df.groupBy(part, "run").agg(F.max("seq").alias("seq"), F.max("section").alias("section"), F.max_by(F.struct("path", "unit"), "seq").alias("s"), F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("seq", "line")))).alias("lines")).filter(F.size("lines") > 0)
    none = lambda kind: F.lit(None).cast(kind)
    shared = [part, "run", "seq", "section"]
    runs = runs.select(*shared, F.lit(0).alias("piece"), F.lit("text").alias("kind"), F.col("s.path").alias("section_path"), F.col("s.unit").alias("unit"), F.when(F.col("s.unit").isNotNull(), "preceding_caption").alias("unit_source"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("body"), none("string").alias("extra"), none("int").alias("n_rows"), none("int").alias("n_cols"), none("double").alias("numeric_ratio"))
    in_header = F.array_join(F.transform("headers", lambda h: F.coalesce(h, F.lit(""))), " ")
    pieces = df.filter(table).withColumn("own", caption_unit(in_header)).withColumn("x", F.explode(split_rows(F.col("rows"), size)))
    extra = F.when(F.size("rows") > size, F.format_string("(표 %d–%d행 / 전체 %d행)", F.col("x.piece") * size + 1, F.col("x.piece") * size + F.size("x.rows"), F.size("rows")))
    pieces = pieces.select(*shared, F.col("x.piece").alias("piece"), F.lit("table").alias("kind"), F.col("path").alias("section_path"), F.coalesce("own", "unit").alias("unit"), F.when(F.col("own").isNotNull(), "table_header").when(F.col("unit").isNotNull(), "preceding_caption").alias("unit_source"), table_text(F.col("headers"), F.col("x.rows")).alias("body"), extra.alias("extra"), F.size("x.rows").alias("n_rows"), F.size("headers").alias("n_cols"), numeric_share(F.col("x.rows")).alias("numeric_ratio"))
    chunks = runs.unionByName(pieces)
    # labels of each section by their first places, with the dates that the document gives them
    labels = df.filter(F.size("named") > 0).select(part, "section", "seq", F.posexplode("named").alias("pos", "label"))
    labels = labels.groupBy(part, "section", "label").agg(F.min(F.struct("seq", "pos")).alias("at"))
    labels = labels.join(_shown(labels.select(part, "label").distinct(), periods, part), [part, "label"], "left") if periods is not None else labels.withColumn("shown", none("string"))
    labels = labels.groupBy(part, "section").agg(F.array_sort(F.collect_list(F.struct("at", "label", "shown"))).alias("labels"))
    chunks = chunks.join(labels, [part, "section"], "left").withColumn("labels", F.filter(F.coalesce("labels", F.array()), lambda x: x["at"]["seq"] <= F.col("seq")))
    chunks = chunks.withColumn("dated", F.filter("labels", lambda x: x["shown"].isNotNull()))
    chunks = chunks.join(meta.select(part, *META), part, "left") if meta is not None else chunks.select("*", *[none("string").alias(c) for c in META])
    if confidence is not None:
        tables = chunks.filter("kind = 'table'").select(part, "seq", F.array_join("section_path", " ").alias("titles")).distinct().join(confidence, part).filter((F.col("caption") != "") & F.contains(F.col("titles"), F.col("caption")))
        chunks = chunks.join(tables.groupBy(part, "seq").agg(F.min_by("parse_confidence", "place").alias("parse_confidence"), F.lit("table").alias("kind")), [part, "seq", "kind"], "left")
    else:
        chunks = chunks.withColumn("parse_confidence", none("string"))
    header = context_header(*[F.col(c) for c in META], F.col("section_path"), F.col("unit"), F.col("dated"), F.col("extra"))
    chunks = chunks.withColumn("text", F.concat_ws("\n", F.nullif(header, F.lit("")), "body"))
    # footnotes go to the last piece, and may tell its unit
    notes = df.filter(attached).groupBy(part, F.col("of_table").alias("seq")).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", text.alias("text")))), lambda x: x["text"]).alias("footnotes"))
    chunks = chunks.withColumn("final", F.max("piece").over(Window.partitionBy(part, "seq", "kind")) == F.col("piece"))
    chunks = chunks.join(notes.withColumn("kind", F.lit("table")).withColumn("final", F.lit(True)), [part, "seq", "kind", "final"], "left")
    known = F.when((F.col("kind") == "table") & (F.col("numeric_ratio") >= NUMERIC), (F.coalesce("unit", F.lit("")) != "") | F.col("text").rlike(UNIT_ANYWHERE))
    told = ~F.coalesce(known, F.lit(False)) & F.exists(F.coalesce("footnotes", F.array()), lambda x: x.rlike(UNIT_ANYWHERE))
    place = F.row_number().over(Window.partitionBy(part).orderBy("run", F.when(F.col("kind") == "table", 0).otherwise(1), "piece")) - 1
    full = F.concat_ws("\n", "text", F.when(F.size("footnotes") > 0, F.array_join("footnotes", "\n")))
    dates = F.map_from_entries(F.transform("dated", lambda x: F.struct(x["label"], x["shown"])))
    return chunks.select(
        part, F.format_string("%s#%04d", F.col(part).cast("string"), place).alias("chunk_id"), *META, "kind", "section_path", "unit", F.when(told, F.coalesce("unit_source", F.lit("footnote"))).otherwise(F.col("unit_source")).alias("unit_source"),
        F.transform("labels", lambda x: x["label"]).alias("periods"), dates.alias("period_dates"), full.alias("text"), F.length(full).alias("n_chars"), "n_rows", "n_cols", "numeric_ratio", "parse_confidence", F.when(told, True).otherwise(known).alias("unit_known"), "footnotes",
    )


def _shown(labels: DataFrame, periods: DataFrame, part: str) -> DataFrame:
    """part, label and the period shown: that of the dictionary's longest label that this one begins with, blanks aside; null if it has none."""
    known = periods.filter("period is not null").select(part, "place", without_blanks(F.col("label")).alias("known"), F.when(F.col("period.kind") == "duration", F.concat("period.begin", F.lit(" ~ "), "period.end")).when(F.col("period.kind") == "instant", F.col("period.begin")).alias("shown"))
    met = labels.withColumn("own", without_blanks(F.col("label"))).join(known.filter("known != ''"), part).filter(F.startswith(F.col("own"), F.col("known")))
    best = met.groupBy(part, "label", "known").agg(F.min_by("shown", "place").alias("shown"))
    return best.groupBy(part, "label").agg(F.max_by("shown", F.length("known")).alias("shown"))


def chunk_statistics(chunks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, lengths, and the share of numeric tables whose unit is known."""
    numeric = F.col("unit_known").isNotNull() & (F.col("kind") == "table") & (F.col("numeric_ratio") >= NUMERIC)
    return chunks.groupBy(*(by or [])).agg(
        F.count("*").alias("n_chunks"), F.count_if(F.col("kind") == "table").alias("n_tables"), F.sum("n_chars").alias("n_chars"), F.count_if(numeric).alias("n_numeric"),
        F.bround(F.count_if(numeric & F.col("unit_known")) / F.nullif(F.count_if(numeric), F.lit(0)), 4).alias("unit_coverage"),
    )

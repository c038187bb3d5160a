"""State that follows document order, as windows: sections, carried units, islands, pieces, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEEPEST = 6


def section_path(blocks: DataFrame, part: list[str], seq: str, level: Column, title: Column) -> DataFrame:
    """Adds path: the open headings' titles at each block; level is null for blocks that are none.

    A heading's place in the path is the lesser of one more than the last path's length and its level;
    unrolled, the i-th heading's length is i + min(0, least of level_k - k for k <= i). Each column of
    the path is then the last title that was written at its place.
    """
    w = Window.partitionBy(*part).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    lvl = F.greatest(F.lit(1), F.least(F.lit(DEEPEST), level))
    df = blocks.withColumn("__l", F.when(level.isNotNull(), lvl)).withColumn("__i", F.count("__l").over(w))
    slack = F.least(F.lit(0), F.min(F.col("__l") - F.col("__i")).over(w))
    df = df.withColumn("__n", F.last(F.when(F.col("__l").isNotNull(), F.col("__i") + slack), True).over(w))
    df = df.withColumn("__t", F.when(F.col("__l").isNotNull(), title))
    places = [F.last(F.when(F.col("__l").isNotNull() & (F.col("__n") == k), F.col("__t")), True).over(w) for k in range(1, DEEPEST + 1)]
    df = df.withColumn("__p", F.array(*places))
    return df.withColumn("path", F.slice("__p", F.lit(1), F.coalesce(F.col("__n"), F.lit(0)).cast("int"))).drop("__l", "__i", "__n", "__t", "__p")


def section_number(part: list[str], seq: str, is_heading: Column) -> Column:
    """How many headings a part has had up to each block."""
    return F.count_if(is_heading).over(Window.partitionBy(*part).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0))


def carried(value: Column, part: list[str], seq: str) -> Column:
    """The last value that is not null, of this row or earlier ones of its part."""
    return F.last(value, True).over(Window.partitionBy(*part).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0))


def gathered(blocks: DataFrame, values: Column, part: list[str], seq: str, name: str = "gathered") -> DataFrame:
    """Adds the distinct elements of the arrays so far, in the order in which they came: each element's first place is found once, and a row takes those up to its own."""
    each = blocks.select(*part, F.col(seq).alias("__s"), F.posexplode(values).alias("__i", "__x"))
    first = each.groupBy(*part, "__x").agg(F.min(F.struct("__s", "__i")).alias("__at"))
    lists = first.groupBy(*part).agg(F.array_sort(F.collect_list(F.struct("__at", "__x"))).alias("__all"))
    seen = F.filter(F.coalesce("__all", F.array()), lambda x: x["__at"]["__s"] <= F.col(seq))
    return blocks.join(lists, part, "left").withColumn(name, F.transform(seen, lambda x: x["__x"])).drop("__all")


def gathered_count(value: Column, part: list[str], seq: str) -> Column:
    """How many distinct values a part has had up to each row, with no list of them."""
    fresh = F.row_number().over(Window.partitionBy(*part, value).orderBy(seq)) == 1
    return F.count_if(fresh & value.isNotNull()).over(Window.partitionBy(*part).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0))


def text_islands(blocks: DataFrame, part: list[str], seq: str, is_text: Column, text: Column) -> DataFrame:
    """Runs of text blocks between others: part, island, first and last seq, and the texts joined by lines."""
    w = Window.partitionBy(*part).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks.withColumn("island", F.count_if(~is_text).over(w)).filter(is_text)
    return rows.groupBy(*part, "island").agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count("*").alias("n_blocks"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), text.alias("t")))), lambda x: x["t"]), "\n").alias("text"))


def split_rows(rows: Column, size: int = 40) -> Column:
    """Pieces of at most `size` rows with their range; no rows are one empty piece, and a lone piece has no range."""
    n = F.size(rows)
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / size).cast("int") - 1)), lambda i: F.struct(i.alias("piece"), F.slice(rows, i * size + 1, F.lit(size)).alias("rows"), F.when(n > size, F.concat((i * size + 1).cast("string"), F.lit("-"), F.least(n, (i + 1) * size).cast("string"))).alias("note")))


def row_pieces(df: DataFrame, by: list[str], order: list[str], size: int = 40) -> DataFrame:
    """The same for tables of one row to a line: adds piece and note, with sorts that spill and nothing collected."""
    w = Window.partitionBy(*by)
    df = df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    piece = F.floor(F.col("__i") / size)
    note = F.when(F.col("__n") > size, F.concat((piece * size + 1).cast("string"), F.lit("-"), F.least(F.col("__n"), (piece + 1) * size).cast("string")))
    return df.withColumn("piece", piece).withColumn("note", note).drop("__i", "__n")


def attach_direction(kind: Column, before: Column, after: Column) -> Column:
    """Where a caption belongs: a unit to the table behind it or else before; a footnote the other way round."""
    unit = F.when(after, "next").when(before, "prev")
    note = F.when(before, "prev").when(after, "next")
    return F.when(kind == "unit", unit).when(kind == "footnote", note)


def neighbours(value: Column, part: list[str], seq: str) -> tuple[Column, Column]:
    w = Window.partitionBy(*part).orderBy(seq)
    return F.lag(value).over(w), F.lead(value).over(w)


def intervals(df: DataFrame, number: str, by: list[str] | None = None) -> DataFrame:
    """Runs of consecutive numbers as closed intervals."""
    by = by or []
    rows = df.select(*by, number).distinct()
    island = F.col(number) - F.row_number().over(Window.partitionBy(*by).orderBy(number))
    return rows.withColumn("__k", island).groupBy(*by, "__k").agg(F.min(number).alias("start"), F.max(number).alias("end")).drop("__k")


def whole_intervals(df: DataFrame, number: str, block: int = 1 << 16) -> DataFrame:
    """intervals() of a table without a key: numbers are compressed in blocks, and only the intervals at a block's borders, two of each at most, meet in one window."""
    parts = intervals(df.select(number).withColumn("__b", F.floor(F.col(number) / block)), number, ["__b"])
    border = (F.col("start") == F.col("__b") * block) | (F.col("end") == F.col("__b") * block + (block - 1))
    w = Window.orderBy("start")
    new = F.when(F.lag("end").over(w) == F.col("start") - 1, 0).otherwise(1)
    met = parts.filter(border).withColumn("__new", new).withColumn("__g", F.sum("__new").over(w)).groupBy("__g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return parts.filter(~border).select("start", "end").unionByName(met.drop("__g"))


def expand(df: DataFrame, start: str = "start", end: str = "end", name: str = "number") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(start, end))).drop(start, end)


def numbered_keys(key: Column, part: list[str], seq: str) -> Column:
    """Repeated keys get #2, #3 and so on."""
    n = F.row_number().over(Window.partitionBy(*part, key).orderBy(seq))
    return F.when(n == 1, key).otherwise(F.concat(key, F.lit("#"), n.cast("string")))


def last_wins(df: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    """Of rows with the same key the one that comes last; an aggregate, so that tasks send one row for each key."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("__r")).select(*key, "__r.*")


def first_wins(df: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*seq)).alias("__r")).select(*key, "__r.*")


def budget_batches(df: DataFrame, cost: str, budget: float, part: list[str], order: list[str], schema: str) -> DataFrame:
    """Greedy batches in order: one closes when its greatest cost times its size would pass the budget.

    The greatest cost of a batch depends on where it began, so no frame expresses it: one pass over
    each part, which `part` must keep small.
    """
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, batch, n, most, out = pdf.sort_values(order, kind="stable"), 0, 0, 0.0, []
        for c in pdf[cost]:
            if n and max(most, c) * (n + 1) > budget:
                batch, n, most = batch + 1, 0, 0.0
            n, most = n + 1, max(most, c)
            out.append(batch)
        return pdf.assign(batch=out)

    return df.groupBy(*part).applyInPandas(run, schema)

"""Small results as text: metrics, sweeps, notices between markers. Everything here is on the driver and small by nature."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def markdown_table(rows: list[dict]) -> str:
    if not rows:
        return ""
    names = list(rows[0])
    show = lambda v: "" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "\\|")
    return "\n".join(["| " + " | ".join(names) + " |", "|" + "---|" * len(names), *("| " + " | ".join(show(r[n]) for n in names) + " |" for r in rows)])


def metrics_report(each: DataFrame, means: DataFrame, title: str = "Retrieval") -> str:
    """Means with how many questions they are of, and a line for each question."""
    m = means.first().asDict()
    top = [{"metric": k, "mean": v, "n": m[f"n_{k}"]} for k, v in m.items() if not k.startswith("n_")]
    return f"# {title}\n\n{markdown_table(top)}\n\n{markdown_table([r.asDict() for r in each.orderBy('id').collect()])}\n"


def inject(text: str, name: str, content: str) -> str:
    """The text with what lies between `<!-- BEGIN name -->` and `<!-- END name -->` replaced; without the markers an error."""
    begin, end = f"<!-- BEGIN {name} -->", f"<!-- END {name} -->"
    if begin not in text or end not in text:
        raise ValueError(f"no markers for {name}")
    return re.sub(re.escape(begin) + r".*?" + re.escape(end), lambda _: f"{begin}\n{content}\n{end}", text, count=1, flags=re.S)


def insert_notices(text: str, notices: list[tuple[int, str]], meta: str = "notices") -> str:
    """The text with notices before their lines (from 1), from the bottom up; a text that has the meta line already is left alone."""
    mark = f"<!-- {meta} -->"
    if mark in text:
        return text
    lines = text.split("\n")
    for n, notice in sorted(notices, reverse=True):
        lines.insert(n - 1, notice)
    return "\n".join([mark, *lines])


def write_markdown(documents: DataFrame, name: str, text: str, path: str) -> None:
    """A folder for each document's name with its text in it."""
    documents.select(F.col(name).alias("name"), F.col(text).alias("value")).write.mode("errorifexists").partitionBy("name").option("lineSep", "\n").text(path)


def profile_summary(tags: DataFrame, rare: int = 3) -> DataFrame:
    """Tags with marks for those in few documents and those with other than ASCII letters; the most frequent first."""
    return tags.withColumn("is_rare", F.col("n_docs") <= rare).withColumn("is_ascii", F.col("tag").rlike(r"^[\x00-\x7f]*$")).orderBy(F.desc("n"), "tag")

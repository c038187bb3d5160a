"""A declarative rule engine: rules over text columns that count, escape or only record."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """id, stage, a pattern (null: decided elsewhere), what is done (count, escape, record, defer), severity and replacement."""

    id: str
    stage: str
    pattern: str | None = None
    handle: str = "count"
    severity: str = "info"
    to: str = ""


#: The two text rules of the policy. Ampersands and angle brackets are counted and left alone.
RULES = (
    Rule("E1_bare_ampersand", "sanitize", r"&(?!amp;|lt;|gt;|quot;|apos;|#\d+;|#x[0-9a-fA-F]+;)"),
    Rule("E2_bare_lt", "sanitize", r"<(?![/?!]|[A-Za-z])"),
    Rule("E3_cp949_fallback", "encoding", severity="warn", handle="record"),
    Rule("E4_library_container", "tree", severity="error", handle="record"),
)


def runnable(rules: tuple[Rule, ...], stage: str) -> list[Rule]:
    return [r for r in rules if r.stage == stage and r.pattern]


def apply_stage(df: DataFrame, text: str, rules: tuple[Rule, ...], stage: str) -> DataFrame:
    """The text after the stage's rules, in order, and `actions`: rule, action, severity, count and first samples of each that hit."""
    actions: list[Column] = []
    for r in runnable(rules, stage):
        if r.handle not in ("count", "record", "escape", "defer"):
            raise ValueError(f"unknown handling {r.handle!r} of {r.id}")
        n = F.regexp_count(F.col(text), F.lit(r.pattern))
        samples = F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({r.pattern}.{{0,20}})"), F.lit(1)), 1, 5)
        df = df.withColumn(f"__{r.id}", F.struct(F.lit(r.id).alias("rule"), F.lit(stage).alias("stage"), F.lit(r.handle).alias("action"), F.lit(r.severity).alias("severity"), n.cast("long").alias("count"), samples.alias("samples")))
        if r.handle == "escape":
            df = df.withColumn(text, F.regexp_replace(text, r.pattern, r.to))
        actions.append(F.col(f"__{r.id}"))
    found = F.filter(F.array(*actions), lambda a: a["count"] > 0) if actions else F.array()
    return df.withColumn("actions", found).drop(*[f"__{r.id}" for r in runnable(rules, stage)])


def summary(actions: DataFrame, rules: tuple[Rule, ...], part: str, doc: str) -> DataFrame:
    """Every rule with its total, parts and documents; rules without hits stay, with zeros."""
    spark = actions.sparkSession
    known = spark.createDataFrame([(r.id, r.stage, r.severity) for r in rules], "rule string, stage string, severity string")
    got = actions.groupBy("rule").agg(F.sum(F.coalesce("count", F.lit(1))).alias("total"), F.countDistinct(part).alias("n_parts"), F.countDistinct(doc).alias("n_docs"))
    return known.join(got, "rule", "left").na.fill(0, ["total", "n_parts", "n_docs"])


def pivot_groups(actions: DataFrame, groups: list[str], group: str = "doc_group") -> DataFrame:
    """Counts of each rule by group in a fixed column order, and in all."""
    wide = actions.groupBy("rule").pivot(group, groups).agg(F.sum("count")).na.fill(0, groups)
    return wide.withColumn("total", reduce(lambda a, b: a + b, [F.col(g) for g in groups]))

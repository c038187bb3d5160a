"""The validation suite: named checks, each a verdict with figures; strictness and sampling of the inputs."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.operators import checks, joins
from docloom.session import ship

Check = Callable[..., DataFrame]
CHECKS: dict[str, Check] = {}
#: Exit codes: all passed, some failed, some could not be run.
PASSED, FAILED, BROKEN = 0, 2, 3


def check(name: str) -> Callable[[Check], Check]:
    """Registers a check: a function of named DataFrames that returns one row with n and failed."""

    def add(f: Check) -> Check:
        CHECKS[name] = f
        return f

    return add


def _row(df: DataFrame, failed: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.coalesce(F.count_if(failed), F.lit(0)).alias("failed"))


@check("encoding")
def encoding(sources: DataFrame, **_) -> DataFrame:
    """Decoded sources have a share of Hangul of five in a hundred or more."""
    letters = F.regexp_count("text", F.lit(r"\S"))
    return _row(sources, (letters > 0) & (F.regexp_count("text", F.lit("[가-힣]")) < 0.05 * letters))


@check("sanitize")
def sanitize(sources: DataFrame, escaped: DataFrame, **_) -> DataFrame:
    """An escaped text grew by four characters for each ampersand that was escaped."""
    both = sources.select("key", F.length("text").alias("a")).join(escaped.select("key", F.length("text").alias("b"), "n_escaped"), "key")
    return _row(both, F.col("b") - F.col("a") != 4 * F.col("n_escaped"))


@check("structure")
def structure(blocks: DataFrame, expected: DataFrame, **_) -> DataFrame:
    """As many headings are reached as the source has sections."""
    got = blocks.groupBy("key").agg(F.count_if(F.col("kind") == "h").alias("got"))
    return _row(expected.join(got, "key", "left"), F.col("n_sections") != F.coalesce("got", F.lit(0)))


@check("grid")
def grid(blocks: DataFrame, **_) -> DataFrame:
    return _row(blocks.filter("kind = 't'"), ~checks.rectangular(F.col("rows")))


@check("regression")
def regression(baseline: DataFrame, current: DataFrame, **_) -> DataFrame:
    return _row(joins.regression(baseline, current, "key", "sha"), F.col("status") != "PASS")


@check("grounding")
def grounding(facts: DataFrame, values: DataFrame, **_) -> DataFrame:
    """Every fact's value stands in its document."""
    return _row(joins.containment(facts, values, ["key"], "value"), F.col("how") == "missing")


@check("units")
def units(chunks: DataFrame, **_) -> DataFrame:
    """Numeric tables say whether their unit is known."""
    return _row(chunks.filter((F.col("kind") == "table") & (F.col("numeric_ratio") >= 0.2)), F.col("unit_known").isNull())


@check("keys")
def keys(facts: DataFrame, **_) -> DataFrame:
    """No two facts have the same place and code."""
    k = F.struct("key", "table_idx", "row_idx", "col_idx", "code")
    return facts.agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct(k)).alias("failed"))


@check("contract")
def contract(index_chunks: DataFrame, required: list[str], **_) -> DataFrame:
    got = checks.contract(index_chunks, required, "chunk_id", "receipt_no")
    return got.select("n", (sum((F.col(f"blank_{c}") for c in required), F.lit(0)) + F.col("repeated_keys") + F.col("bad_receipts")).alias("failed"))


@check("vectors")
def vectors(index: DataFrame, dim: int, **_) -> DataFrame:
    h = checks.vector_health(index, "embedding", dim)
    return h.select("n", (F.col("wrong_dim") + F.col("not_finite") + F.col("zero") + F.col("not_unit")).alias("failed"))


@check("coverage")
def coverage(tokens: DataFrame, **_) -> DataFrame:
    """tokens: key, source and output (arrays): no document lost more than a twentieth of its tokens and more than twenty."""
    lost, n = F.size(checks.token_loss(F.col("source"), F.col("output"))), F.size("source")
    return _row(tokens, (n > 0) & (lost > 0.05 * n) & (lost > 20))


@check("sums")
def sums(identities: DataFrame, **_) -> DataFrame:
    """Every identity that could be checked (statements.identities) holds, or an alternative of it does."""
    return _row(identities, F.col("status") == "fail")


@check("captions")
def captions(judged: DataFrame, **_) -> DataFrame:
    """Every caption that is attached points at a table."""
    bad = ((F.col("attach") == "next") & ~F.col("after_real")) | ((F.col("attach") == "prev") & ~F.col("before_real"))
    return _row(judged.filter("caption is not null"), F.coalesce(bad, F.lit(False)))


@check("periods")
def periods(period_dates: DataFrame, bodies: DataFrame, **_) -> DataFrame:
    """Every date of a period stands in its document: period_dates has key and period, bodies key and text."""
    from docloom.operators.documents import ungrounded_dates

    bad = ungrounded_dates(period_dates, bodies, "key", "text").select("key").distinct().withColumn("bad", F.lit(True))
    return _row(period_dates.select("key").distinct().join(bad, "key", "left"), F.col("bad").isNotNull())


@check("index")
def index(manifest: DataFrame, document_index: DataFrame, fields: list[str], **_) -> DataFrame:
    """Every manifest row is in the index once, with the same fields."""
    differ = joins.reconcile(manifest, document_index, "doc_id", fields).select("doc_id").distinct().withColumn("differ", F.lit(True))
    have = document_index.groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    return _row(manifest.select("doc_id").distinct().join(have, "doc_id", "left").join(differ, "doc_id", "left"), (F.coalesce("n_rows", F.lit(0)) != 1) | F.col("differ").isNotNull())


def run(spark: SparkSession, names: list[str] | None = None, **inputs) -> tuple[list[dict], int]:
    """Runs the checks whose inputs are there. A check without rows has no verdict; one that breaks is told and doesn't end the others."""
    out, code = [], PASSED
    for name in names or list(CHECKS):
        f = CHECKS[name]
        wanted = [a for a in f.__code__.co_varnames[: f.__code__.co_argcount]]
        if any(inputs.get(a) is None for a in wanted):
            out.append({"check": name, "verdict": None, "n": None, "failed": None, "error": "inputs missing"})
            continue
        try:
            r = f(**inputs).withColumn("verdict", checks.verdict(F.col("failed"), F.col("n"))).first()
            out.append({"check": name, "verdict": r["verdict"], "n": r["n"], "failed": r["failed"], "error": None})
            code = max(code, FAILED if r["verdict"] == "fail" else PASSED)
        except Exception as e:  # noqa: BLE001  told in the report
            out.append({"check": name, "verdict": "error", "n": None, "failed": None, "error": str(e)[:200]})
            code = BROKEN
    return out, code


def strictness(df: DataFrame, text: str) -> DataFrame:
    """Adds xml_status: strict_ok for well-formed XML, else recovered if there are tags at all, else failed."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def status(s: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            if x is None:
                return None
            try:
                ET.fromstring(x)
            except ET.ParseError:
                return "recovered" if "<" in x and ">" in x else "failed"
            return "strict_ok"

        return s.map(one)

    return df.withColumn("xml_status", status(F.col(text)))


def systematic_sample(df: DataFrame, by: list[str], order: str, every: int) -> DataFrame:
    """Every n-th row of each group in order."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("__n", F.row_number().over(w) - 1).filter(F.col("__n") % every == 0).drop("__n")

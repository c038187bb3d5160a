"""Checks of data quality. A check is a DataFrame of violations, or a row of figures and a verdict; null is not applicable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.scalars import norm


def contract(df: DataFrame, required: list[str], key: str, receipt: str | None = None) -> DataFrame:
    """One row: rows, blanks of each required field, repeated keys, receipts without eight leading digits."""
    blank = lambda c: F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(f"blank_{c}")
    more = [F.count_if(~F.coalesce(F.col(receipt), F.lit("")).rlike(r"^\d{8}")).alias("bad_receipts")] if receipt else []
    return df.agg(F.count("*").alias("n"), *[blank(c) for c in required], (F.count(key) - F.countDistinct(key)).alias("repeated_keys"), *more)


def require(df: DataFrame, required: list[str], key: str) -> DataFrame:
    """df, or an error that names what breaks the contract."""
    got = contract(df, required, key).first().asDict()
    bad = {k: v for k, v in got.items() if k != "n" and v}
    if bad:
        raise ValueError(f"contract broken: {bad}")
    return df


def vector_health(df: DataFrame, vector: str, dim: int, tolerance: float = 1e-3) -> DataFrame:
    v = F.col(vector)
    n = norm(v)
    return df.agg(F.count("*").alias("n"), F.count_if(F.size(v) != dim).alias("wrong_dim"), F.count_if(F.exists(v, lambda x: F.isnan(x) | x.isNull())).alias("not_finite"), F.count_if(n < 1e-6).alias("zero"), F.count_if(F.abs(n - 1) > tolerance).alias("not_unit"), F.min(n).alias("least_norm"), F.max(n).alias("greatest_norm"))


def token_loss(source: Column, output: Column) -> Column:
    """Tokens of the source that the output lacks, but for artefacts of joining: those inside an output token, or made of two known parts of three letters and more."""
    missing = F.array_except(source, output)
    inside = lambda t: F.exists(output, lambda o: F.contains(o, t))
    halves = lambda t: (F.length(t) >= 6) & F.exists(F.sequence(F.lit(3), F.length(t) - 3), lambda i: F.array_contains(output, F.substring(t, F.lit(1), i)) & F.array_contains(output, F.substring(t, i + 1, F.length(t))))
    return F.filter(missing, lambda t: ~inside(t) & ~F.coalesce(F.when(F.length(t) >= 6, halves(t)), F.lit(False)))


def coverage(df: DataFrame, source: str, output: str, by: list[str], most_ratio: float = 0.05, most: int = 20) -> DataFrame:
    """Mean and greatest share of lost tokens by group, and documents that lose too large a share and too many."""
    lost, n = F.size(token_loss(F.col(source), F.col(output))), F.size(source)
    share = F.when(n > 0, lost / n).otherwise(0.0)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(share).alias("mean_loss"), F.max(share).alias("greatest_loss"), F.count_if((share > most_ratio) & (lost > most)).alias("failed"))


def violations(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """key and rule for each condition that a row breaks; a null condition is not applicable."""
    each = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(key, F.explode(each).alias("rule"))


def rectangular(rows: Column) -> Column:
    return F.size(F.array_distinct(F.transform(rows, lambda r: F.size(r)))) <= 1


def verdict(failed: Column, n: Column) -> Column:
    """pass or fail; null if there was nothing to check."""
    return F.when(n > 0, F.when(failed == 0, "pass").otherwise("fail"))

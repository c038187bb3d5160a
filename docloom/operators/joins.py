"""Joins of the document pipeline: lookups by several keys, longest prefixes, differences, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_cascade(df: DataFrame, manifest: DataFrame, keys: list[tuple[Column, str]], value: str, name: str = "found") -> DataFrame:
    """The first of several lookups that succeeds: (key of df, key column of manifest), each an equi-join; greatest value of repeated keys."""
    for i, (key, column) in enumerate(keys):
        side = manifest.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"__k{i}")).agg(F.max(value).alias(f"__v{i}"))
        df = df.withColumn(f"__q{i}", key)
        df = df.join(side, F.col(f"__q{i}") == F.col(f"__k{i}"), "left").drop(f"__k{i}", f"__q{i}")
    vs = [F.col(f"__v{i}") for i in range(len(keys))]
    by = reduce(lambda acc, i: acc.when(vs[i].isNotNull(), F.lit(keys[i][1])), range(1, len(vs)), F.when(vs[0].isNotNull(), F.lit(keys[0][1])))
    return df.withColumn(name, F.coalesce(*vs)).withColumn(f"{name}_by", by).drop(*[f"__v{i}" for i in range(len(keys))])


def longest_prefix(df: DataFrame, text: str, prefixes: DataFrame, prefix: str, keep: list[str], lengths: tuple[int, ...]) -> DataFrame:
    """Each text's longest prefix of the dictionary, and the rest of the text as qualifier; nulls without one.

    Texts meet the dictionary by equality on their beginnings of the lengths that it has, not by a
    comparison of all with all.
    """
    cuts = df.select(*keep, text, F.explode(F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.substring(F.col(text), F.lit(1), n))).alias(prefix)).filter(F.length(prefix) > 0).distinct()
    met = cuts.join(prefixes.select(prefix).distinct(), prefix, "left_semi").groupBy(*keep, text).agg(F.max_by(prefix, F.length(prefix)).alias(prefix))
    out = df.join(met, [*keep, text], "left")
    return out.withColumn("qualifier", F.when(F.col(prefix).isNotNull(), F.trim(F.substring(F.col(text), F.length(prefix) + 1, F.length(text)))))


def regression(baseline: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """NEW, MISSING, FAIL or PASS for each key of two tables of hashes."""
    b, c = baseline.select(key, F.col(value).alias("__b")), current.select(key, F.col(value).alias("__c"))
    status = F.when(F.col("__b").isNull(), "NEW").when(F.col("__c").isNull(), "MISSING").when(F.col("__b") != F.col("__c"), "FAIL").otherwise("PASS")
    return b.join(c, key, "full").select(key, status.alias("status"))


def with_status(manifest: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """All manifest rows, with status: ok, or missing for those without a document."""
    return manifest.join(docs.withColumn("__ok", F.lit(True)), key, "left").withColumn("status", F.when(F.col("__ok"), "ok").otherwise("missing")).drop("__ok")


def reconcile(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A row for each differing field (null-safe) of keys that both tables have: key, field, left, right."""
    left, right = a.select(key, *[F.col(c).cast("string").alias(f"__a_{c}") for c in columns]), b.select(key, *[F.col(c).cast("string").alias(f"__b_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"__a_{c}").alias("left"), F.col(f"__b_{c}").alias("right")) for c in columns])
    return left.join(right, key).select(key, F.explode(F.filter(pairs, lambda p: ~p["left"].eqNullSafe(p["right"]))).alias("d")).select(key, "d.*")


#: Characters of a value's beginning through which it meets the places of others.
BEGINNING = 8


def containment(facts: DataFrame, values: DataFrame, part: list[str], value: str) -> DataFrame:
    """Adds how: exact where the part has the value itself, inside where another value of the part holds it, else missing.

    Values without an equal are told by equality from the pieces of their part's values. A place is kept
    if some such value begins as it does, in BEGINNING characters (or all of a shorter value), and gives
    a piece for each length that these values have. So rows grow with places and lengths, not with pairs.
    """
    own = values.select(*part, F.col(value).alias("__v")).filter("__v is not null").distinct()
    df = facts.join(own.withColumnRenamed("__v", value).withColumn("__e", F.lit(True)), [*part, value], "left")
    rest = df.filter(F.col("__e").isNull() & F.col(value).isNotNull()).select(*part, value).distinct()
    begins = rest.filter(F.length(value) > 0).groupBy(*part, F.substring(value, 1, BEGINNING).alias("__b")).agg(F.collect_set(F.length(value)).alias("__n"))
    sizes = begins.agg(F.collect_set(F.length("__b")).alias("__s"), F.max(F.array_max("__n")).alias("__m"))  # one row of BEGINNING numbers at most
    places = own.filter(F.length("__v") > 0).crossJoin(F.broadcast(sizes)).select(*part, "__v", "__s", "__m", F.explode(F.sequence(F.lit(1), F.length("__v"))).alias("__i"))
    places = places.select(*part, F.substring("__v", F.col("__i"), F.col("__m")).alias("__t"), F.explode("__s").alias("__l")).filter(F.length("__t") >= F.col("__l"))
    met = places.select(*part, "__t", F.substring("__t", F.lit(1), F.col("__l")).alias("__b")).join(begins, [*part, "__b"])
    pieces = met.select(*part, "__t", F.explode("__n").alias("__l")).filter(F.length("__t") >= F.col("__l")).select(*part, F.substring("__t", F.lit(1), F.col("__l")).alias(value)).distinct()
    empty = rest.filter(F.length(value) == 0).join(own.select(*part).distinct(), part, "left_semi")  # nothing is in everything
    inside = rest.join(pieces, [*part, value], "left_semi").union(empty).withColumn("__i", F.lit(True))
    return df.join(inside, [*part, value], "left").withColumn("how", F.when(F.col("__e"), "exact").when(F.col("__i"), "inside").otherwise("missing")).drop("__e", "__i")

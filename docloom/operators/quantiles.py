"""Exact quantiles of large groups: no group is collected or sorted in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_statistics(df: DataFrame, by: list[str], value: str, ranks: dict[str, F.Column], buckets: int = 64) -> DataFrame:
    """The group's keys and, by name, its value at each rank; a rank is an expression of the group's size `n`, from 0. Nulls are left out.

    Approximate quantiles cut a group into buckets; sums of their counts tell which bucket holds a rank,
    and only that bucket's distinct values are summed up in order.
    """
    rows = df.select(*by, F.col(value).alias("v")).filter("v is not null")
    cuts = rows.groupBy(*by).agg(F.percentile_approx("v", [i / buckets for i in range(1, buckets)], 10 * buckets).alias("cuts"), F.count("*").alias("n"))
    counts = rows.groupBy(*by, "v").agg(F.count("*").alias("c"))
    counts = counts.join(cuts, by).withColumn("bucket", F.size(F.filter("cuts", lambda x: x < F.col("v")))).drop("cuts")
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items()]))
    before = F.coalesce(F.sum("size").over(Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = counts.groupBy(*by, "bucket", "n").agg(F.sum("c").alias("size")).withColumn("before", before)  # `buckets` rows for each group
    target = sums.withColumn("w", wanted).filter((F.col("w.rank") >= F.col("before")) & (F.col("w.rank") < F.col("before") + F.col("size")))
    target = target.select(*by, "bucket", "before", "w.name", "w.rank")
    upto = F.sum("c").over(Window.partitionBy(*by, "bucket", "name").orderBy("v"))
    found = counts.drop("n").join(target, [*by, "bucket"]).withColumn("upto", F.col("before") + upto).filter("rank < upto")
    return found.groupBy(*by).pivot("name", list(ranks)).agg(F.min("v"))


def percentiles(df: DataFrame, by: list[str], value: str, at: dict[str, float]) -> DataFrame:
    """Percentiles with linear interpolation between neighbours, as columns by name."""
    place = lambda q: (F.col("n") - 1) * F.lit(q)
    ranks = {f"{side}_{name}": f(place(q)) for name, q in at.items() for side, f in (("low", F.floor), ("high", F.ceil))}
    sizes = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"))
    rows = order_statistics(df, by, value, ranks).join(sizes, by)
    mixed = [(F.col(f"low_{name}") + (F.col(f"high_{name}") - F.col(f"low_{name}")) * (place(q) - F.floor(place(q)))).alias(name) for name, q in at.items()]
    return rows.select(*by, *mixed)

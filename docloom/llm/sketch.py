"""Threshold-scaled sketches of word shingles, in DataFrame functions only.

Every shingle hash below a fixed fraction of the hash range is retained, and no other, so that sketches
of documents of any length are samples of their shingles at one rate: they merge by union, and
containment and likeness are estimated from what two sketches share. A short text may retain no hash:
its containment is null, since nothing was sampled, and an exact key of its words tells it from others.

Nulls: a null text is empty; empty texts have an empty sketch, and two of them are alike (1). A null
doc_id comes last in the descending order; doc_id must fit a long. Repeated ids are ordered by the hash
of the text, and so are ties of null ids; equal rows are interchangeable. Texts of any length are read
whole. An empty table gives no rows. A lone document is followed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents

SHINGLE, FRACTION = 5, 0.25
#: Hexadecimal digits of a hash in a fingerprint.
DIGITS = 12
_RANGE = 1 << 48
_SPACES = " \t\n\x0b\f\r"


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def sketch(text: Column, n: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """The sorted distinct 48-bit hashes of the text's word n-grams below fraction; a text of fewer words is one n-gram."""
    bound = F.lit(int(_RANGE * fraction))
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")

    def hashes(w: Column) -> Column:
        each = F.transform(w, lambda x: F.xxhash64(x))
        mixed = lambda h, i: F.shiftrightunsigned(F.xxhash64(h, *[F.get(_h, i + k) for k in range(1, n)]), 16)

        def grams(hs: Column) -> Column:
            nonlocal _h
            _h = hs
            return F.when(F.size(hs) < n, F.array(F.shiftrightunsigned(F.xxhash64(hs), 16))).otherwise(F.filter(F.transform(hs, mixed), lambda h, i: i <= F.size(_h) - n))

        _h = None
        return _let(each, grams)

    kept = _let(_let(words, hashes), lambda h: F.array_sort(F.array_distinct(F.filter(h, lambda x: x < bound))))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(kept)


def exact(text: Column) -> Column:
    """A hash of the text's words in order, for texts whose sketches are empty; null without a word."""
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(trimmed != "", F.xxhash64(F.regexp_replace(trimmed, r"[\x20\x09-\x0D]+", " ")))


def fingerprint(hashes: Column, key: Column) -> Column:
    """The sketch as a string: DIGITS hexadecimal digits for each hash; without any, `=` and the exact key; nothing for an empty text."""
    digits = F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0")), "")
    return F.when(F.size(hashes) > 0, digits).otherwise(F.coalesce(F.concat(F.lit("="), F.lpad(F.lower(F.hex(key)), 16, "0")), F.lit("")))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """The share of a's shingles that b has too, estimated from size(a) of them; null if a retains none."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column, a_key: Column, b_key: Column) -> Column:
    """Shared shingles as a part of all, estimated; of two empty sketches 1 if the words are the same, or 0."""
    both = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both, a_key.eqNullSafe(b_key).cast("double")).otherwise(_let(F.size(F.array_intersect(a, b)), lambda s: s / (F.size(a) + F.size(b) - s)))


def _in_order() -> Window:
    """The descending order within a bucket, with a copy of the next bucket's first document behind it."""
    return Window.partitionBy("bucket", "part").orderBy("extra", F.col("doc_id").desc_nulls_last(), "hash", "text")


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, hash, next_text, bucket, part and extra: the text of the next document in descending doc_id; after the last comes the first.

    Documents go to buckets of doc_id by its quantiles, in one shuffle. An id that several quantiles
    fall on has a bucket of its own, cut by the texts' hashes into as many parts, and so have null ids
    by their share. Each bucket gets a copy of the first document of the one that follows, marked by
    `extra`, so that its last document meets it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 20 * n).alias("q"), F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    cuts = known["q"] if n > 1 and known["q"] else []
    hot = {v: cuts.count(v) + 1 for v in set(cuts) if cuts.count(v) > 1}
    bounds = sorted({*cuts, *(v + 1 for v in hot if v < 2**63 - 1)})
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    if bounds:  # the count of bounds <= doc_id, by binary search
        array = F.array(*[F.lit(b).cast("long") for b in bounds])
        bucket = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(array, at + s - 1) <= F.col("doc_id")), at + s).otherwise(at))
    else:
        bucket = F.lit(0)
    parts = F.when(F.col("doc_id").isNull(), max(1, round(n * known["nulls"] / max(1, known["n"]))))
    for v, m in hot.items():  # at most half as many as there are quantiles
        parts = parts.when(F.col("doc_id") == v, m)
    part = F.shiftright((F.shiftright("hash", 32) + F.lit(1 << 31)) * parts.otherwise(1), 32)
    placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(bucket)).withColumn("part", part).withColumn("extra", F.lit(False))
    heads = placed.groupBy("bucket", "part").agg(F.max(F.struct("doc_id", F.bitwise_not("hash").alias("hash"))).alias("h")).collect()  # one row for each bucket
    heads = sorted(heads, key=lambda r: (-r["bucket"], r["part"]))
    if not heads:
        return placed.withColumn("next_text", F.col("text"))
    follows = [(r["bucket"], r["part"], heads[(i + 1) % len(heads)]["h"]) for i, r in enumerate(heads)]
    target = F.broadcast(spark.createDataFrame([(b, k, h["doc_id"], ~h["hash"]) for b, k, h in follows], "to int, to_part long, head long, head_hash long"))
    copies = placed.join(target, F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash")))
    copies = copies.groupBy(F.col("to").alias("bucket"), F.col("to_part").alias("part"), "doc_id", "hash").agg(F.min("text").alias("text")).withColumn("extra", F.lit(True))
    return placed.unionByName(copies).withColumn("next_text", F.lead("text").over(_in_order()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(documents(spark, sf_dir))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.substring("next_text", F.lit(1), F.floor(n / 2).cast("int")))
    rows = rows.withColumn("edited", F.when(~F.col("extra"), edited))
    own, other = sketch(F.col("text")), F.when(~F.col("extra"), sketch(F.col("edited")))
    rows = rows.select("doc_id", "bucket", "part", "extra", "hash", "text", n.cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), own.alias("own"), other.alias("other"), "edited")
    key = lambda hashes, text: F.when(F.size(hashes) == 0, exact(F.col(text)))
    rows = rows.withColumn("own_key", key("own", "text")).withColumn("other_key", key("other", "edited"))
    order = _in_order()
    rows = rows.withColumn("after", F.lead(F.struct("own", "own_key")).over(order)).filter(~F.col("extra"))
    near_edited = likeness(F.col("own"), F.col("other"), F.col("own_key"), F.col("other_key"))
    near_next = likeness(F.col("own"), F.col("after.own"), F.col("own_key"), F.col("after.own_key"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own"), F.col("own_key")).alias("fingerprint"), fingerprint(F.col("other"), F.col("other_key")).alias("edited_fingerprint"), near_edited.alias("near_edited"), near_next.alias("near_next"))

"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two halves. Of two fingerprints that differ in at most three bits, one half
differs in at most one: the table holds each fingerprint under both halves, the probe side enumerates
the Hamming ball of radius one around each half, and what it meets is verified over all 64 bits. Of
two values that differ in one bit, the one that lacks it probes, so that a pair is met once a half.
Equal fingerprints are one vertex; components of the verified links are found by alternating
large-star and small-star rounds over checkpointed edges.

Nulls: a null text is empty, with fingerprint zero; a row with a null doc_id takes part and has the
smallest non-null id of its component, or null. Repeated rows are members like any other. Texts of any
length are read whole, shingle by shingle. An empty table gives no rows. Other columns don't matter.

Rows with one half in common meet in one task unless adaptive execution splits them: these are distinct
fingerprints, which share 32 bits by chance only if they are near, so that a key holds few but for texts
made to collide; below the threshold of skew such a key is joined in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, documents, drop_table, id_and_text, write_table

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SEED, SHINGLE, MAX_BITS = 42, 3, 3
HALF = 0xFFFFFFFF


def fingerprint(text: bytes, n: int = SHINGLE, at_once: int = 1 << 16) -> int:
    """The 64-bit SimHash of a text's word n-grams, repeats included, over XXH64."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    total, ones = max(1, len(words) - n + 1), np.zeros(64, np.int64)
    for a in range(0, total, at_once):
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), SEED) for i in range(a, min(total, a + at_once))]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        found = np.array([fingerprint(x.encode()) for x in block.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([block.column(0), *block.columns[2:], pa.array(found.view(np.int64))], [*block.schema.names[:1], *block.schema.names[2:], "fp"])


def fingerprints(docs: DataFrame, *more: F.Column) -> DataFrame:
    """doc_id, further columns, and fp: the fingerprint as a signed long."""
    rows = id_and_text(docs, *more)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(_fingerprints, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", fp long")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs a, b of distinct fingerprints (column fp) that differ in at most max_bits (3 at most)."""
    if max_bits > 3:
        raise ValueError("two halves and balls of radius one find up to three differing bits")
    low, high = F.col("fp").bitwiseAND(F.lit(HALF)), F.shiftrightunsigned("fp", 32)
    halves = distinct.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("half"), low.alias("key")), F.struct(F.lit(1).alias("half"), high.alias("key")))).alias("h")).select("fp", "h.*")
    flips = F.filter(F.array(*[F.lit(1 << i) for i in range(32)]), lambda bit: F.col("key").bitwiseAND(bit) == 0)
    ball = F.concat(F.array(F.lit(0).cast("long")), flips)
    probes = halves.select(F.col("fp").alias("p"), "half", F.explode(F.transform(ball, lambda bit: F.col("key").bitwiseOR(bit))).alias("key"), F.col("key").alias("own"))
    differ = F.expr("p ^ fp")
    near = F.bit_count(differ) <= max_bits
    once = (F.col("own") != F.col("key")) | (F.col("p") < F.col("fp"))  # equal halves meet from both sides
    first = (F.col("half") == 0) | (F.bit_count(differ.bitwiseAND(F.lit(HALF))) > 1)  # what the low halves find too
    pairs = probes.join(halves, ["half", "key"]).filter((F.col("p") != F.col("fp")) & once & first & near)
    return pairs.select(F.least("p", "fp").alias("a"), F.greatest("p", "fp").alias("b"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node and root (the least node it reaches) for every node of the edges a, b.

    Large-star links each node's greater neighbours to its least one, small-star its lesser ones; both
    keep connectivity and never add edges, and the rounds end when nothing changes.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            near = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select(F.col("b"), F.col("a")))
        else:
            near = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = near.join(least, "u")
        if large:
            return met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("b"), F.col("m").alias("a")).distinct()
        to_least = met.select(F.col("v").alias("b"), F.col("m").alias("a")).union(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
        return to_least.filter("a != b").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = write_table(edges.select("a", "b").distinct(), "edges")
    was = state(edges)
    for _ in range(max_rounds if was[0] else 0):
        new = write_table(star(star(edges, True), False), "edges")
        drop_table(edges)
        edges = new
        if (now := state(edges)) == was:
            break
        was = now
    else:
        if was[0]:
            raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, *more: F.Column) -> DataFrame:
    """doc_id, further columns, fp, root: the component's least fingerprint, and component_id: the smallest doc_id that links reach.

    Components may share a component_id (null ids, an id on rows with different texts), but never a root.
    """
    prints = write_table(fingerprints(docs, *more), "fingerprints")
    distinct = write_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    member = components(links(distinct.select("fp"), max_bits))
    # few fingerprints have links: the others are components of their own
    linked = distinct.join(member, distinct["fp"] == member["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = linked.join(classes, "root").select("fp", "root", "component_id")
    return prints.join(ids, "fp")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id, null last, then with the smallest hash of its text; of repeated rows one."""
    tie = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    found = near_duplicates(docs, MAX_BITS, tie.alias("tie"))
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("k"))
    zero = F.lit(0).cast(docs.schema["doc_id"].dataType)
    id_of = lambda c: [F.coalesce(c, zero).alias("id"), c.isNull().alias("none")]  # noqa: E731  plain keys, so that the join and the window share one exchange
    keys = ["id", "none", "tie"]
    whole = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole")
    rows = docs.select(whole, *id_of(docs["doc_id"]), tie.alias("tie")).join(kept.select(*id_of(F.col("k.doc_id")), F.col("k.tie").alias("tie")), keys, "left_semi")
    one = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).filter("n = 1")
    return one.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])

"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

Nulls: a null text is empty and has only the end id; a null doc_id sorts first. doc_id must fit a long.
Repeated ids keep all their rows, ordered by a hash of the text and then by the text; equal rows are
interchangeable, and told apart only so that they need not lie in one range. Texts of any length are
encoded whole. An empty table gives files without rows. Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, documents, id_and_text, scratch_path
from .tokens import ENCODE_BYTES, default_path, library_ids

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = library_ids(path), TaskContext.get().partitionId(), 0
        for block in blocks(batches, ENCODE_BYTES):
            ids, at = encoder.encode(block.column(1))
            ids = np.insert(ids, at[1:], end_id).astype(np.int32)
            at = at + np.arange(len(at))
            counts = np.diff(at)
            arrays = [block.column(0).cast(pa.int64()), pa.array(np.full(len(counts), part, np.int32)), pa.array(start + at[:-1]), pa.array(counts), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "part", "part_start", "n_tokens", "ids"])
            start += int(at[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, stripe_bytes: int = 64 << 20, row_index_stride: int = 10_000) -> None:
    """Writes ids of all texts, each with end_id behind it, in ascending doc_id order over the files.

    The texts are range-partitioned by doc_id once; each task encodes its range and writes stripes
    whose ids are run-length encoded. `part` numbers the ranges in order and `part_start` counts the
    ids before a document in its range, so that places in the whole stream need only sums by range.
    """
    rows = id_and_text(docs).withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    (
        ranged.mapInArrow(_encode(tokenizer or default_path(), end_id), SCHEMA)
        .write.option("compression", "zstd").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true").option("orc.row.index.stride", str(row_index_stride)).option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents with their ids; with doc_ids, stripes are skipped by their indexes and Bloom filters."""
    found = spark.read.schema(SCHEMA).orc(path)
    return found if doc_ids is None else found.filter(F.col("doc_id").isin(doc_ids))


def stream_starts(tokens: DataFrame) -> DataFrame:
    """`part` and the number of ids in all ranges before it: one row for each range."""
    sums = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        flat = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
        at = ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start in the whole stream, n_tokens and the crc32 of the ids."""
    tokens = read_tokens(spark, path)
    rows = tokens.select("doc_id", "part", "part_start", "ids").mapInArrow(_digest, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    joined = rows.join(stream_starts(tokens), "part")
    return joined.select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path)
    return token_digest(spark, path)

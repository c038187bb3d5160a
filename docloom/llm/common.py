"""What the corpus operators share: tables, the shared folder, blocks of texts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import ship

#: Characters of text that an operator holds at once (a longer text is a block of its own).
BLOCK_CHARS = 2_000_000
#: The white space of the word rule `[^\x20\x09-\x0D]+`; bytes.split() cuts at the same.
SPACE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, a temporary one on one machine, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='docloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's process ends."""
    path = f"{shared_dir(spark)}/docloom-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


def write_table(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder, in a folder for each value of `by`, and reads it back."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def drop_table(table: DataFrame) -> None:
    """Removes what write_table() wrote, once nothing reads it any more."""
    _remove(table.sparkSession, table._written)


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of doc_id as text, mod `mod`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def id_and_text(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, text (null: empty) and further columns, whatever else the table has; operators with Python code begin here."""
    ship(docs.sparkSession)
    return docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"), *more)


def blocks(batches: Iterable[pa.RecordBatch], chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `chars` bytes in column `text`, one row at least."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        sizes = np.nan_to_num(pc.binary_length(text).to_numpy(zero_copy_only=False)).astype(np.int64)
        total, at = np.concatenate([[0], np.cumsum(sizes)]), 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(total, total[at] + chars, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def smallest_hashes(df: DataFrame, tie: str, n: int, *order: str) -> DataFrame:
    """The n rows with the smallest hashes in the long column `tie`, then by `order`.

    A cut a little above the n-th smallest hash is taken from the count of rows, so that tasks send the
    driver n rows together and not n each; below it are n rows or more but for a chance of nothing.
    """
    total = df.count()
    if total > n:
        cut = int(min(1.0, (1.1 * n + 10 * n**0.5 + 100) / total) * 2**64) - 2**63
        df = df.filter(F.col(tie) <= min(cut, 2**63 - 1))
    return df.orderBy(tie, *order).limit(n)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls: empty) as one array, and where each row begins, with the end."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values between successive bounds; empty rows sum to 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def take_ragged(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the chosen rows of a ragged array, one after another, and their lengths."""
    lengths = at[rows + 1] - at[rows]
    ends = np.cumsum(lengths)
    where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[rows] - (ends - lengths), lengths)
    return flat[where], lengths

"""Sources: manifests, raw files, index tables; and the sinks that write them."""

from __future__ import annotations

import io
import pickle
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.scalars import short_sha1, strip
from docloom.session import checkpoint_dir, ship

MANIFEST = "doc_id string, doc_group string, doc_subtype string, corp_code string, corp_name string, listed_name string, flr_nm string, stock_code string, industry string, sector string, report_nm string, rcept_no string, rcept_dt string, is_correction boolean, base_year string, base_month string, file_path string, file_format string, n_files int"
CHUNK = "chunk_id string, embedding_text string, doc_id string, stock_code string, disclosure_type string, receipt_no string, company string, document_title string, section_path array<string>, content string, is_superseded boolean"
QUESTION = "id string, question string, company string, expect_companies array<string>, expect_any array<string>, tags array<string>"


def read_manifest(spark: SparkSession, path: str, group: str | None = None, limit: int | None = None) -> DataFrame:
    """Manifest rows with trimmed strings; a line that is no JSON fails the read. The last of repeated ids wins."""
    df = spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(path)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    df = df.withColumn("__place", place).select(*[strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields], "__place")
    if group is not None:
        df = df.filter(F.col("doc_group") == group)
    last = Window.partitionBy("doc_id").orderBy(F.desc("__place"))
    df = df.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n", "__place")
    return df.limit(limit) if limit else df


def list_files(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """path, modificationTime, length and content of files below root."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)


def jobs(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows with the sorted files of their folder; status tells those that have none."""
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    found = files.groupBy(folder.alias("folder")).agg(F.array_sort(F.collect_list("path")).alias("files"))
    own = F.regexp_extract("file_path", r"([^/]+)/?$", 1)
    return manifest.join(found, own == F.col("folder"), "left").drop("folder").withColumn("status", F.when(F.col("files").isNull(), "no_source").otherwise("ok"))


def decode(df: DataFrame, content: str = "content", fallback: str = "cp949") -> DataFrame:
    """Adds text, encoding, had_bom and n_replaced: UTF-8 if it is valid, else the fallback with replacements.

    Valid UTF-8 stays in the JVM; only other files go through Python, as Spark's decoder has no
    replacing mode for that code page.
    """
    ship(df.sparkSession)
    @F.pandas_udf("string")
    def other(raw: pd.Series) -> pd.Series:
        return raw.map(lambda x: None if x is None else bytes(x).decode(fallback, "replace"))

    bom = F.substring(F.hex(F.substring(content, 1, 3)), 1, 6) == "EFBBBF"
    body = F.when(bom, F.expr(f"substring({content}, 4)")).otherwise(F.col(content))
    df = df.withColumn("had_bom", bom).withColumn("__body", body)
    valid = F.is_valid_utf8(F.col("__body").cast("string"))
    df = df.withColumn("encoding", F.when(valid, "utf-8").otherwise(fallback))
    df = df.withColumn("text", F.when(valid, F.col("__body").cast("string")).otherwise(other(F.when(~valid, F.col("__body")))))
    return df.withColumn("n_replaced", F.regexp_count("text", F.lit("�"))).drop("__body")


def looks_like_filing(source: Column) -> Column:
    return F.contains(F.upper(F.substring(source, 1, 600)), F.lit("<DOCUMENT"))


def looks_like_viewer(source: Column) -> Column:
    return ~F.contains(F.lower(source), F.lit("<iframe")) & source.rlike(r'(?i)class\s*=\s*["\'][^"\']*section-[0-9]')


def part_key(doc_id: Column, receipt: Column, path: Column) -> Column:
    """doc_id and what the file's name has behind the receipt."""
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    at = F.position(receipt, name)
    return F.concat(doc_id, F.when(at > 0, F.substring(name, at + F.length(receipt), F.length(name))).otherwise(F.lit("")))


def id_map(chunks: DataFrame) -> DataFrame:
    """Chunks with their row: a position in the order of files and lines, given once and dense.

    Rows are numbered in range partitions of (file, chunk_id); the numbers before a partition are sums
    over one row for each partition.
    """
    spark = chunks.sparkSession
    checkpoint_dir(spark)
    parts = chunks.repartitionByRange("chunk_id").withColumn("__p", F.spark_partition_id()).checkpoint()  # the same ranges for counts and numbers
    counts = {r["__p"]: r["n"] for r in parts.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    total, before = 0, []
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    starts = spark.createDataFrame(before or [(0, 0)], "__p int, __before long")
    own = Window.partitionBy("__p").orderBy("chunk_id")
    rows = parts.join(F.broadcast(starts), "__p").withColumn("row", F.col("__before") + F.row_number().over(own) - 1)
    return rows.select("row", "chunk_id", "doc_id", F.col("stock_code").alias("corp_code"), F.col("disclosure_type").alias("doc_group"), F.substring("receipt_no", 1, 4).try_cast("smallint").alias("base_year"), F.substring("receipt_no", 1, 8).alias("rcept_dt"), "company", "receipt_no", short_sha1(F.col("embedding_text")).alias("embed_sha1"))


def write_once(df: DataFrame, path: str, kind: str = "parquet", order: list[str] | None = None) -> None:
    """Writes a new table; an existing one is never overwritten."""
    (df.sortWithinPartitions(*order) if order else df).write.mode("errorifexists").format(kind).save(path)


def write_index(chunks: DataFrame, path: str) -> None:
    """The two index tables, compressed with zstd: texts and id map."""
    rows = id_map(chunks)
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/id_map")
    texts = rows.select("row", "chunk_id").join(chunks.select("chunk_id", F.col("embedding_text").alias("embed_text")), "chunk_id")
    texts.select("row", "chunk_id", "embed_text", F.octet_length("embed_text").alias("n_bytes")).write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/embed_texts")


def write_report(df: DataFrame, path: str, by: str) -> None:
    """A small report as CSV, greatest first."""
    df.orderBy(F.desc(by)).write.mode("errorifexists").option("header", "true").csv(path)


def digests(spark: SparkSession, root: str) -> DataFrame:
    """path, length and SHA-256 of all files below root."""
    return list_files(spark, root, "*").select("path", "length", F.sha2("content", 256).alias("sha256"))


def verify_package(expected: DataFrame, found: DataFrame) -> DataFrame:
    """path and status of two tables of digests: ok, mismatch, missing or extra."""
    e, f = expected.select("path", F.col("sha256").alias("want")), found.select("path", F.col("sha256").alias("got"))
    status = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("got") == F.col("want"), "ok").otherwise("mismatch")
    return e.join(f, "path", "full").select("path", status.alias("status"))


def compact(chunks: DataFrame, skipped: DataFrame, path: str) -> None:
    """The chunks without those of skipped documents, as a new table."""
    write_once(chunks.join(skipped.select("doc_id"), "doc_id", "left_anti"), path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of the index contract; a line that is no JSON fails the read."""
    return spark.read.schema(CHUNK).option("mode", "FAILFAST").json(path)


def chunks_of_rows(chunks: DataFrame, ids: DataFrame, rows: DataFrame) -> DataFrame:
    """The chunks at some rows of the id map (column row), with their rows: a point lookup as two joins, whose small side Spark sends out."""
    return rows.select("row").join(ids.select("row", "chunk_id"), "row").join(chunks, "chunk_id")


def misplaced(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """Chunks without a row and rows without a chunk: chunk_id and status; none if the two go together."""
    status = F.when(F.col("row").isNull(), "no_row").otherwise("no_chunk")
    both = chunks.select("chunk_id", F.lit(1).alias("__c")).join(ids.select("chunk_id", "row"), "chunk_id", "full")
    return both.filter(F.col("row").isNull() | F.col("__c").isNull()).select("chunk_id", status.alias("status"))


class _Plain(pickle.Unpickler):
    """Reads plain values only: a stream that names a class or function is taken as broken there."""

    def find_class(self, module: str, name: str):
        raise pickle.UnpicklingError(f"{module}.{name} is no plain value")


def records(data: bytes) -> tuple[list, int]:
    """The values of a stream of pickles up to its first that is cut off or broken, and the bytes up to there."""
    stream, found, good = io.BytesIO(data), [], 0
    while True:
        try:
            found.append(_Plain(stream).load())
        except Exception:  # noqa: BLE001  a broken record raises whatever its bytes make of it
            return found, good
        good = stream.tell()


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """row, token_id and weight from files of pickled batches [(row, {token_id: weight})]; a cut-off tail is left out.

    n_bytes is the file's length and n_good what a writer may keep of it and append to. A file is one task's.
    """
    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, good = records(data)
                rows = [(name, r, int(t), float(w), len(data), good) for b in found for r, weights in b for t, w in weights.items()]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.float32(), pa.int64(), pa.int64()), strict=True)], ["path", "row", "token_id", "weight", "n_bytes", "n_good"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, row long, token_id int, weight float, n_bytes long, n_good long")


def read_questions(spark: SparkSession, path: str, only: list[str] | None = None, limit: int | None = None) -> DataFrame:
    df = spark.read.schema(QUESTION).json(path)
    df = df.filter(F.col("id").isin(only)) if only else df
    return df.orderBy("id").limit(limit) if limit else df


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parts of compressed JSON documents, one row each."""
    return spark.read.schema(schema).json(path).select("*", F.posexplode("parts").alias("part_no", "part")).drop("parts")


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "gzip").json(path)


def first_by_receipt(index: DataFrame, receipt: str = "rcept_no", order: str = "doc_id") -> DataFrame:
    """One index row for each receipt, the first by id."""
    rest = [c for c in index.columns if c != receipt]
    return index.groupBy(receipt).agg(F.min_by(F.struct(*rest), order).alias("r")).select(receipt, "r.*")


def without_skipped(df: DataFrame, skipped: DataFrame | None, key: str = "doc_id") -> DataFrame:
    return df if skipped is None else df.join(skipped.select(key), key, "left_anti")


def sibling_aliases(spark: SparkSession, path: str, prefix: str = "별칭: ") -> DataFrame:
    """From Markdown files below path, by folder: the longest alias line's names."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).filter(F.startswith("value", F.lit(prefix)))
    names = F.transform(F.split(F.substring("value", F.lit(len(prefix) + 1), F.length("value")), ","), lambda x: F.trim(x))
    return lines.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("folder"), names.alias("names")).groupBy("folder").agg(F.max_by("names", F.size("names")).alias("names"))

"""Streams: windows with late data, de-duplication, and incremental rebuilds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marked(stream: DataFrame, time: str, late: str) -> DataFrame:
    """The stream with a watermark, which needs a timestamp with a time zone."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def tumbling(events: DataFrame, width: str, *by: str, time: str = "ts", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window, of a batch or of a stream; a stream's rows later than `late` are dropped."""
    kind = events.schema[time].dataType
    df = marked(events, time, late) if events.isStreaming else events
    return df.groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast(kind).alias("start"), *by, "n", "total")


def distinct_events(events: DataFrame, key: str, time: str = "ts", late: str = "2 hours") -> DataFrame:
    """The first row of each key; a stream forgets keys that are older than `late`."""
    return marked(events, time, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def to_rebuild(sources: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Sources that are new, changed by more than a microsecond, or made under another configuration."""
    d = done.select(F.col(key).alias("__k"), F.col("modified").alias("__m"), F.col("config_hash").alias("__c"))
    stale = F.col("__k").isNull() | (F.abs(F.col("modified") - F.col("__m")) > 1e-6) | ~F.col("config_hash").eqNullSafe(F.col("__c"))
    return sources.join(d, F.col(key) == F.col("__k"), "left").filter(stale).drop("__k", "__m", "__c")


def keep_latest(stream: DataFrame, path: str, key: list[str], receipt: str, checkpoint: str):
    """A streaming query whose table at `path` holds each key's row with the greatest receipt; every batch makes a new version folder."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        have = sorted(int(s.getPath().getName().removeprefix("v")) for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))) if fs.exists(root) else []
        have = [v for v in have if v < epoch]  # a batch that is repeated is made again from the one before
        old = spark.read.parquet(f"{path}/v{have[-1]}") if have else None
        rows = batch if old is None else old.unionByName(batch)
        rest = [c for c in rows.columns if c not in key]
        rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(receipt)).alias("r")).select(*key, "r.*").write.mode("overwrite").parquet(f"{path}/v{epoch}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

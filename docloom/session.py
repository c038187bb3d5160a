"""Sessions with the settings the engine expects."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: UTC and adaptive plans; broadcasts stay at Spark's own size check.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("docloom").config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once for each application; they may not have it installed.

    Arrow batches are held to 16 MB unless the session says otherwise: each is in the memory of the
    executor and of its Python worker at once.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":  # Spark's own default
        spark.conf.set(BATCH_BYTES, "16m")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package, out = Path(__file__).resolve().parent, Path(os.path.realpath(tempfile.mkdtemp()), "docloom.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(out))
    _shipped.add(context.applicationId)


def checkpoint_dir(spark: SparkSession) -> None:
    """checkpoint() writes to the folder of spark.checkpoint.dir; where none is set, a temporary one on one machine, and an error on a cluster."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='docloom-')}")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))

"""The corpus pipeline: its stages, each over all that its predecessor kept.

Nulls: a null text is empty, and the rules reject it; a null doc_id stays null, and such documents are
kept or dropped by their texts like others. Repeated rows are judged each, and the near-duplicate stage
leaves one row of them. Ties between copies go to the smallest doc_id, null last, then to the smallest
hash of the text. Texts of any length are read whole. An empty table gives no rows. Further columns of
documents, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import packing, quality, rules, simhash
from docloom.llm.common import documents, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules.stage),
    ("quality classifier", quality.stage),
    ("near duplicates", simhash.stage),
    ("packing", packing.stage),
]
#: SimHash fingerprints, the trained classifier and tokenization have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

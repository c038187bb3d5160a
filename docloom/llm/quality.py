"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of labelled documents are gathered on the executors and the trees are grown in numpy on
the driver, from a bounded sample of labelled rows (MAX_LABELLED, by a hash of the id). Trees are
flattened into arrays; a block of documents walks all of them level by level in numpy.

Nulls: a null text is empty and scored like any other; a null doc_id stays null, is no training row
and counts as crc32 of the empty text for held_out. Null labels are no training rows. Repeated rows
are scored each; in the sample an id counts once. Ties of hashes are broken by the id, of splits by the
first feature and bound. Texts of any length are read whole. Empty tables give no rows; without two
classes the score is the labels' mean, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, documents, id_and_text, per_row, remainder, smallest_hashes, text_bytes
from .rules import _IS_DIGIT, _IS_SPACE, _IS_SYMBOL, _IS_UPPER, lines_of, repeated_words

#: The most labelled rows that the trees are grown from, and the threshold of `predicted`.
MAX_LABELLED, THRESHOLD = 20_000, 0.3
FEATURES = ("words", "chars_per_word", "distinct_words", "repeated_words", "lines", "repeated_lines", "symbols", "upper", "digits", "exclaims", "pipes", "stops", "commas", "wide", "short_words", "long_words")


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    raw, at = text_bytes(texts)
    data, ends = raw.tobytes(), at.tolist()
    rows = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    words = [x.split() for x in rows]
    n = np.fromiter(map(len, words), np.float64, len(words))
    sizes = np.fromiter((len(w) for row in words for w in row), np.int64, int(n.sum()))
    word_at = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    lines = np.array([lines_of(x) for x in rows], np.float64).reshape(-1, 2)
    chars = per_row(((raw & 0xC0) != 0x80) & (_IS_SPACE[raw] == 0), at).astype(np.float64)
    some, wide = np.maximum(n, 1), np.maximum(chars, 1)
    return np.column_stack([
        np.log1p(n), chars / some, np.fromiter((len(set(x)) for x in words), np.float64, len(words)) / some, repeated_words(words) / some, np.log1p(lines[:, 0]), lines[:, 1] / np.maximum(lines[:, 0], 1),
        per_row(_IS_SYMBOL[raw], at) / some, per_row(_IS_UPPER[raw], at) / wide, per_row(_IS_DIGIT[raw], at) / wide, per_row(raw == 33, at) / some, per_row(raw == 124, at) / some, per_row(raw == 46, at) / some, per_row(raw == 44, at) / some,
        per_row(raw >= 0xC0, at) / wide, per_row(sizes <= 2, word_at) / some, per_row(sizes > 12, word_at) / some,
    ])


@dataclass
class Trees:
    """Flattened trees: node i of tree t has its children at 2i+1 and 2i+2; leaves lie in the last level."""

    feature: np.ndarray  # trees x inner nodes
    bound: np.ndarray
    leaf: np.ndarray  # trees x 2**depth
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, reg: float = 1.0, least: int | None = None) -> Trees:
    """Boosts trees of fixed depth on the logistic loss; splits are sought over histograms of binned values.

    A leaf holds `least` rows, by default ten, and fewer of small samples.
    """
    least = max(2, min(10, len(y) // 50)) if least is None else least
    inner, mean = 2**depth - 1, float(y.mean()) if len(y) else 0.5
    mean = min(max(mean, 1e-3), 1 - 1e-3)
    model = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), float(np.log(mean / (1 - mean))))
    if len(np.unique(y)) < 2:
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    margin, out = np.full(len(y), model.base), ([], [], [])
    width = x.shape[1] * bins
    cell = binned + np.arange(x.shape[1]) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, bound, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first)[:, None] * width + cell).ravel()
            sums = [np.bincount(at, np.repeat(v, x.shape[1]), count * width).reshape(count, x.shape[1], bins) for v in (grad, hess, np.ones(len(y)))]
            left = [np.cumsum(s, axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            gain = lambda g, h: g**2 / (h + reg)
            better = gain(left[0], left[1]) + gain(whole[0] - left[0], whole[1] - left[1]) - gain(whole[0], whole[1])
            better[(left[2] < least) | (whole[2] - left[2] < least)] = 0
            best = better.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins)
                if better[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + k], bound[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > bound[node])
        g, h = (np.bincount(node - inner, v, inner + 1) for v in (grad, hess))
        leaf = -rate * g / (h + reg)
        margin += leaf[node - inner]
        for k, v in enumerate((feature, bound, leaf)):
            out[k].append(v)
    return Trees(*(np.array(v) for v in out), model.base)


def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        x = statistics(block.column(1))
        yield pa.RecordBatch.from_arrays([block.column(0), *block.columns[2:], pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "quality", "place", "x"])


def sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, mod: int = 5, held: int = 0) -> DataFrame:
    """doc_id, quality and statistics x of max_labelled labelled documents at most, whose crc32(doc_id) mod `mod` is not `held`.

    Those with the smallest hashes of their ids are taken; the ids alone are broadcast, so that texts
    aren't shuffled. An id counts once: with its smallest label, and of several rows the one whose text
    has the smallest hash.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder(F.col("doc_id"), mod) != held))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = smallest_hashes(known.withColumn("tie", F.xxhash64("doc_id")), "tie", max_labelled, "doc_id")
    rows = id_and_text(docs, F.xxhash64(docs["text"]).alias("place")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality", "place")
    found = rows.mapInArrow(_gather, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, place long, x array<double>")
    return found.groupBy("doc_id", "quality").agg(F.min_by("x", "place").alias("x"))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, mod: int = 5, held: int = 0) -> Trees:
    """Trees from a bounded sample of labelled rows."""
    found = sample(docs, labels, max_labelled, mod, held).toArrow().combine_chunks()
    x = np.array(found.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y = found.column("quality").to_numpy().astype(np.float64)
    order = np.lexsort([*x.T, y])  # the rows come in any order; sums in floating point must not depend on it
    return fit(x[order], y[order])


def scored(docs: DataFrame, model: Trees, *more: F.Column) -> DataFrame:
    """doc_id, further columns, and score: the probability of label 1."""
    rows = id_and_text(docs, *more)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            score = shared.value.score(statistics(block.column(1)))
            yield pa.RecordBatch.from_arrays([block.column(0), *block.columns[2:], pa.array(score)], [*block.schema.names[:1], *block.schema.names[2:], "score"])

    return rows.mapInArrow(run, f"{kept}, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = scored(docs, model)
    return rows.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier predicts 1 for."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    whole = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole")
    kept = scored(docs, model, whole).filter(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])

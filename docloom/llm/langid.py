"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. The weights are trained with
follow-the-regularised-leader and elastic-net penalties on a bounded sample (MAX_PER_LANG documents of
each language, MAX_SAMPLE in all, by a hash of the id), and probabilities are calibrated by a
temperature on a part of the sample that the weights haven't seen.

Nulls: a null text and a text without a letter are `und` with score 0; a null doc_id stays null and
counts as crc32 of the empty text; rows with a null lang are no training rows. Repeated rows are
predicted each; in the sample an id counts once in a language. Ties of hashes are broken by the id, ties
of probabilities by the language's name. Texts of any length are read whole. Empty tables give no rows;
without training rows every prediction is `und`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, documents, id_and_text, remainder
from .tokens import LETTER, classes

MAX_PER_LANG, MAX_SAMPLE = 600, 20_000
#: n-grams of one to ORDER characters are hashed into 2**BITS features.
ORDER, BITS = 3, 15
NONE = "und"


def counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """For each text its features and how often it has them; None if it has no letter.

    Characters are lower-cased and everything but letters counts as a space.
    """
    for text in texts:
        point = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        letter = classes()[point] == LETTER
        if not letter.any():
            yield None
            continue
        point = np.where(letter, point, 32).astype(np.uint64)
        point = point[np.concatenate([[True], letter[1:] | letter[:-1]])]  # one space for each run
        gram, total = np.zeros(len(point), np.uint64), np.zeros(1 << BITS, np.int64)
        for n in range(min(ORDER, len(point))):
            gram = (gram[: len(point) - n] if n == 0 else gram[:-1]) * np.uint64(0x1F0001) + point[n:] + np.uint64(1)
            mixed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
            total += np.bincount(mixed.astype(np.int64), minlength=1 << BITS)
        feature = np.flatnonzero(total)
        yield feature, total[feature]


@dataclass
class Model:
    """Languages, a weight for each feature and language, the bias in the last row, and the temperature."""

    langs: list[str]
    idf: np.ndarray
    weight: np.ndarray
    temperature: float = 1.0

    def logits(self, feature: np.ndarray, count: np.ndarray) -> np.ndarray:
        return tfidf(feature, count, self.idf) @ self.weight[feature] + self.weight[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for i, found in enumerate(counts([x or "" for x in texts])):
            if found is None or not self.langs:
                names.append(NONE)
                continue
            p = softmax(self.logits(*found) / self.temperature)
            names.append(self.langs[int(p.argmax())])
            scores[i] = p.max()
        return names, scores


def tfidf(feature: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf[feature]
    return value / np.sqrt((value**2).sum())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01, seed: int = 7) -> Model:
    """FTRL-Proximal over the rows (features, counts, language); every fifth row is kept for the temperature."""
    langs = sorted({x[2] for x in rows})
    place = {x: i for i, x in enumerate(langs)}
    data = [(np.append(f, len(idf)), np.append(tfidf(f, c, idf), 1.0), place[lang]) for f, c, lang in rows]
    train, held = [x for i, x in enumerate(data) if i % 5], [x for i, x in enumerate(data) if i % 5 == 0]
    if len(data) < 50:
        train = held = data
    z, n = np.zeros((len(idf) + 1, len(langs))), np.zeros((len(idf) + 1, len(langs)))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) > l1, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2), 0.0)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(train)):
            f, x, y = train[i]
            zs, ns = z[f], n[f]
            w = weights(zs, ns)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            grown = ns + g**2
            z[f] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / alpha * w
            n[f] = grown
    model = Model(langs, idf, weights(z, n))
    if held:
        logits = np.array([x @ model.weight[f] for f, x, _ in held])
        right = np.array([y for *_, y in held])

        def loss(t: float) -> float:
            e = logits / t
            top = e.max(axis=1)
            return float((np.log(np.exp(e - top[:, None]).sum(axis=1)) + top - e[np.arange(len(e)), right]).mean())

        model.temperature = min(np.geomspace(0.05, 20, 200).tolist(), key=loss)
    return model


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, rows = np.zeros((1 << BITS) + 1, np.int64), 0
    for block in blocks(batches):
        for x in counts(block.column(1).to_pylist()):
            if x is not None:
                found[x[0]] += 1
                rows += 1
    found[-1] = rows
    feature = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(feature.astype(np.int32)), pa.array(found[feature])], ["feature", "n"])


def _sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        keep, features, values = [], [], []
        for i, x in enumerate(counts(block.column(1).to_pylist())):
            if x is not None:
                keep.append(i)
                features.append(x[0].astype(np.int16).tolist())
                values.append(x[1].astype(np.int32).tolist())
        rows = block.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns[2:], pa.array(features, pa.list_(pa.int16())), pa.array(values, pa.list_(pa.int32()))], ["lang", "tie", "place", "feature", "n"])


def sample(known: DataFrame, per_lang: int = MAX_PER_LANG, most: int = MAX_SAMPLE) -> DataFrame:
    """lang, tie and the features of per_lang documents of each language at most, and of `most` in all: those with the smallest hashes of their ids.

    An id counts once in a language, however many rows have it: of these, the one whose text has the smallest hash.
    """
    ids = known.filter("doc_id is not null").select("doc_id", "lang", F.xxhash64("doc_id").alias("tie"))
    sizes = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n")).collect()}  # a row for each language
    cuts = {lang: min(2**63 - 1, int((1.2 * per_lang + 10 * per_lang**0.5 + 100) / max(size, 1) * 2**64) - 2**63) for lang, size in sizes.items()}
    if cuts:  # of a large language only rows with small hashes are ranked, which are per_lang or more
        cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
        ids = ids.filter(F.col("tie") <= F.element_at(cut, F.col("lang")))
    first = Window.partitionBy("lang").orderBy("tie", "doc_id")
    chosen = ids.distinct().withColumn("k", F.row_number().over(first)).filter(F.col("k") <= per_lang).orderBy("tie", "lang", "doc_id").limit(most).select("doc_id", F.col("lang").alias("known"), "tie")
    rows = id_and_text(known, known["lang"], F.xxhash64("text").alias("place")).join(F.broadcast(chosen), "doc_id").filter("lang = known")
    found = rows.select("doc_id", "text", "lang", "tie", "place").mapInArrow(_sparse, "lang string, tie long, place long, feature array<short>, n array<int>")
    one = found.groupBy("lang", "tie").agg(F.min_by(F.struct("feature", "n"), "place").alias("x"))
    return one.select("lang", "tie", "x.feature", "x.n")


def train(docs: DataFrame, mod: int = 3, held: int = 1, per_lang: int = MAX_PER_LANG) -> Model:
    """A model from texts with a language whose crc32(doc_id) mod `mod` is not `held`."""
    usable = (remainder(docs["doc_id"], mod) != held) & docs["lang"].isNotNull()
    known = docs.filter(usable).select("doc_id", "text", "lang")
    df = id_and_text(known).mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    n = {r["feature"]: r["n"] for r in df}
    total = n.pop(1 << BITS, 0)
    idf = np.log((1 + total) / (1 + np.bincount(list(n), list(n.values()), 1 << BITS))) + 1 if n else np.ones(1 << BITS)
    found = sample(known, per_lang).toArrow()
    got = sorted(zip(*(found.column(c).to_pylist() for c in ("tie", "lang", "feature", "n")), strict=True))
    return fit([(np.array(f, np.int16).astype(np.int64), np.array(c), lang) for _, lang, f, c in got], idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            names, scores = shared.value.predict(block.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = identify(docs, train(docs))
    return rows.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")

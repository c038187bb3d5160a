"""The whole path as one object: files to blocks, blocks to chunks, chunks to an index, questions to evidence, evidence to metrics."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.scalars import coverage_tokens, dot
from docloom.operators import chunks as C
from docloom.operators import retrieval as R
from docloom.session import ship
from docloom.sources import files, markup

Encoder = Callable[[list[str]], np.ndarray]


def hashing_encoder(dim: int = 64) -> Encoder:
    """A deterministic stand-in for a trained encoder: signed hashes of words, with unit length."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                out[i, h % dim] += 1 if h >> 63 else -1
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)

    return encode


def encode(df: DataFrame, text: str, encoder: Encoder, batch: int = 256) -> DataFrame:
    """df with `embedding`, by batches of texts; an encoder that runs out of memory gets halves, and a lone text that does gives null."""
    ship(df.sparkSession)

    def halves(texts: list[str]) -> list:
        try:
            return [x.tolist() for x in encoder(texts)]
        except MemoryError:
            if len(texts) == 1:
                return [None]
            return halves(texts[: len(texts) // 2]) + halves(texts[len(texts) // 2 :])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = pdf[text].fillna("").tolist()
            yield pdf.assign(embedding=[v for a in range(0, len(texts), batch) for v in halves(texts[a : a + batch])])

    from pyspark.sql import types as T

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))]))


class Engine:
    """An index of chunks with dense and sparse scores. `entities`: the names that questions may mention."""

    def __init__(self, spark: SparkSession, index: DataFrame, postings: DataFrame, encoder: Encoder, latest_only: bool = True, w_dense: float = 1.0, w_sparse: float = 1.0):
        self.spark, self.index, self.postings, self.encoder = spark, index, postings, encoder
        self.latest_only, self.w_dense, self.w_sparse = latest_only, w_dense, w_sparse

    @staticmethod
    def chunks(documents: DataFrame, key: str, source: str) -> DataFrame:
        return C.build_chunks(markup.parse_blocks(documents, key, source), key)

    @classmethod
    def build(cls, chunks: DataFrame, encoder: Encoder | None = None, path: str | None = None, **options) -> Engine:
        """From chunks by the index contract (files.CHUNK). With a path, the tables are written there once and read back."""
        encoder = encoder or hashing_encoder()
        ids = files.id_map(chunks)
        periodic = F.col("disclosure_type") == "periodic"
        marked = R.superseded(chunks, ["company", "document_title"], "receipt_no", periodic, "is_superseded")
        rows = ids.join(marked.select("chunk_id", "document_title", "section_path", "content", "embedding_text", "is_superseded"), "chunk_id")
        index = encode(rows, "embedding_text", encoder)
        if path:
            index.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/index")
            index = chunks.sparkSession.read.parquet(f"{path}/index")
        token = F.explode(coverage_tokens(F.lower("embedding_text"))).alias("token")
        postings = index.select("row", token).withColumn("weight", F.lit(0.1))
        return cls(chunks.sparkSession, index, postings, encoder, **options)

    def scored(self, question: str, company: str | None = None, groups: tuple | None = None, years: tuple | None = None) -> DataFrame:
        vector = [float(x) for x in self.encoder([question])[0]]
        q = self.spark.createDataFrame([(question,)], "q string").select(F.explode(coverage_tokens(F.lower("q"))).alias("token")).withColumn("q_weight", F.lit(1.0))
        mask = R.hard_filter(R.company_filter(F.col("company"), F.col("corp_code"), company) if company else None, groups, years, ~F.col("is_superseded") if self.latest_only else None)
        rows = R.dense_scores(self.index.filter(mask), F.array(*map(F.lit, vector)))
        rows = rows.join(R.sparse_scores(self.postings, F.broadcast(q)), "row", "left")
        return rows.withColumn("score", R.weighted(F.col("dense"), F.col("sparse"), self.w_dense, self.w_sparse)).drop("embedding")

    def search(self, question: str, k: int = 5, cap: int | None = None, **filters) -> DataFrame:
        """The k best chunks; with a cap, at most so many of a document. No candidates are an error."""
        rows = self.scored(question, **filters)
        found = R.capped_top_k(rows, k, cap, "doc_id") if cap else R.top_k(rows, k)
        if found.isEmpty():
            raise LookupError("no chunk passes the filters")
        return found

    def entities(self, question: str) -> list[str]:
        """Companies that the question names, in its order."""
        q = self.spark.createDataFrame([(0, question)], "id int, question string")
        found = R.detect_entities(q, self.index.select("company").filter("company is not null").distinct(), "id", "question", "company")
        return [r["entity"] for r in found.orderBy("at").collect()]  # as many as one question names

    def search_multi(self, question: str, k: int = 6, cap: int | None = 2) -> DataFrame:
        """Each named company searched by its own question, and the lists interleaved; fewer than two names: one search."""
        names = self.entities(question)
        if len(names) < 2:
            return self.search(question, k, cap, company=names[0] if names else None)
        quota, parts = R.entity_quota(k, len(names)), []
        for i, name in enumerate(names):
            others = [n for n in names if n != name]
            own = self.spark.createDataFrame([(question, name, others)], "q string, k string, o array<string>").select(R.subquery(F.col("q"), F.col("k"), F.col("o"))).first()[0]
            rows = self.scored(own, company=name)
            parts.append((R.capped_top_k(rows, quota, cap, "doc_id") if cap else R.top_k(rows, quota)).withColumn("entity_order", F.lit(i)))
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        return R.interleave(both, k, "entity_order")

    def ask(self, question: str, k: int = 5, split: bool = True, company: str | None = None, cap: int | None = None) -> DataFrame:
        return self.search(question, k, cap, company=company) if company or not split else self.search_multi(question, k, cap)

    def evaluate(self, questions: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
        """Metrics of each question (files.QUESTION) and their means. Questions are a short list, asked one by one. Names and sections are compared without blanks."""
        hits, wanted_rows = None, []
        bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
        for q in questions.collect():
            wanted_rows.append((q["id"], ["".join(x.split()) for x in q["expect_companies"] or []]))
            found = self.ask(q["question"], k, company=q["company"]).select(F.lit(q["id"]).alias("id"), "rank", bare(F.col("company")).alias("company"), bare(F.concat(F.array_join(F.coalesce("section_path", F.array().cast("array<string>")), " > "), F.lit("|"), F.coalesce("document_title", F.lit("")))).alias("place"))
            wanted = [F.contains("place", F.lit("".join(x.split()))) for x in q["expect_any"] or []]
            ok = F.lit(None).cast("boolean") if not wanted else reduce(lambda a, b: a | b, wanted)
            found = found.withColumn("ok", ok).withColumn("company_ok", F.col("company") == "".join(q["company"].split()) if q["company"] else F.lit(None).cast("boolean"))
            hits = found if hits is None else hits.unionByName(found)
        wanted = self.spark.createDataFrame(wanted_rows, "id string, wanted array<string>")
        seen = hits.groupBy("id").agg(F.collect_set("company").alias("seen")).join(F.broadcast(wanted), "id")  # a row for each question of the list
        each = R.metrics(hits, ["id"], k, company_ok="company_ok").join(seen.select("id", F.bround(R.entity_coverage(F.col("wanted"), F.col("seen")), 4).alias("entity_coverage")), "id")
        return each, R.means(each, ["hit_1", "hit_k", "mrr", "company_1", "company_k", "strict_1", "entity_coverage"])

    def sweep(self, questions: str | DataFrame, settings: list[tuple[float, float]], k: int = 5) -> DataFrame:
        """Each question (one, or a table of id and question) scored once and ranked for each pair of weights; two equal pairs of zeros are left out."""
        pairs = F.array(*[F.struct(F.lit(float(d)).alias("w_dense"), F.lit(float(s)).alias("w_sparse")) for d, s in settings if (d, s) != (0, 0)])
        rows = None
        for i, text in [("0", questions)] if isinstance(questions, str) else [(r["id"], r["question"]) for r in questions.select("id", "question").collect()]:
            one = self.scored(text).drop("score").withColumn("id", F.lit(i))
            rows = one if rows is None else rows.unionByName(one)
        rows = rows.withColumn("w", F.explode(pairs)).select("*", "w.*")
        return R.top_k_each(rows.withColumn("score", F.col("w_dense") * F.col("dense") + F.col("w_sparse") * F.coalesce("sparse", F.lit(0.0))), ["id", "w_dense", "w_sparse"], k)


def re_embedding_cosine(index: DataFrame, encoder: Encoder, text: str = "embedding_text", fraction: float = 0.01, seed: int = 7) -> DataFrame:
    """Least and mean cosine of stored vectors of a sample to vectors made anew."""
    again = encode(index.sample(fraction=fraction, seed=seed).withColumnRenamed("embedding", "stored"), text, encoder)
    return again.select(dot(F.col("stored"), F.col("embedding")).alias("c")).agg(F.min("c").alias("least"), F.avg("c").alias("mean"), F.count("*").alias("n"))

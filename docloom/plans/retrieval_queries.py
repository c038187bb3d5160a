"""Queries of filtered top-k retrieval and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.scalars import norm
from docloom.operators import retrieval as R
from docloom.operators.checks import vector_health

from .registry import query, table

_DOT = "list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))"
#: Every row whose id is divisible by 100 is a query; its words are those of the benchmark text with a hundredth of its id, if there is one.
_SCORED = f"""
WITH q AS (SELECT vec_id AS qid, embedding FROM embeddings WHERE vec_id % 100 = 0),
b AS (SELECT item_id * 100 AS qid, list_distinct(string_split(lower(text), ' ')) AS toks FROM benchmark),
s AS (SELECT q.qid, d.doc_id, d.source, d.lang, round({_DOT}, 6) AS dense,
             CAST(coalesce(len(list_intersect(list_distinct(string_split(lower(d.text), ' ')), b.toks)), 0) AS BIGINT) AS sparse
      FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id, q LEFT JOIN b USING (qid) WHERE d.lang IN ('en', 'fr'))
"""


def query_blocks(spark: SparkSession, sf_dir: str, size: int = 256) -> DataFrame:
    """The query set (qid, q, toks) in blocks of `size` queries at most."""
    words = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 100).alias("qid"), F.array_distinct(F.split(F.lower("text"), " ")).alias("toks"))
    queries = table(spark, sf_dir, "embeddings").filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q")).join(words, "qid", "left")
    return queries.groupBy(F.floor(F.col("qid") / (100 * size)).alias("block")).agg(F.collect_list(F.struct("qid", "q", "toks")).alias("qs"))


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have a vector, in blocks; texts are lower-cased once they are joined."""
    docs = table(spark, sf_dir, "documents").filter(R.hard_filter(groups=("en", "fr"), group="lang")).select("doc_id", "source", "text")
    rows = table(spark, sf_dir, "embeddings").join(docs, F.col("vec_id") == F.col("doc_id")).withColumn("text", F.lower("text"))
    return R.text_blocks(rows, "doc_id", "source", "text")


@query(
    "hybrid_topk",
    _SCORED
    + """, c AS (SELECT *, round(dense + 0.05 * sparse, 6) AS score FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY qid, source ORDER BY score DESC, doc_id) AS n FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM r WHERE n <= 2)
SELECT qid, rank, doc_id, source, dense, sparse, score FROM k WHERE rank <= 10""",
)
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.hybrid_top_k(text_blocks(spark, sf_dir), query_blocks(spark, sf_dir), [(1.0, 0.05)], 10, 2)
    return rows.select("qid", "rank", F.col("row").alias("doc_id"), F.col("group").alias("source"), "dense", "sparse", "score")


@query(
    "dense_topk",
    f"""WITH q AS (SELECT vec_id AS qid, embedding FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT q.qid, e.vec_id, round({_DOT}, 6) AS score FROM embeddings e, q WHERE e.vec_id <> q.qid),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT qid, vec_id, score, rank FROM r WHERE rank <= 5""",
)
def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated query set against all rows, block by block."""
    index = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = index.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "qid")
    return R.dense_top_k(index, queries, 5, "vec_id", "qid")


@query(
    "sparse_topk",
    """WITH p AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) AS token FROM documents),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) AS token FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(count(*) AS DOUBLE) AS score FROM p JOIN q USING (token) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id, doc_id, score, rank FROM r WHERE rank <= 5""",
)
def sparse_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"), F.lit(1)))).alias("token")
    postings = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row"), token).withColumn("weight", F.lit(1.0))
    questions = table(spark, sf_dir, "benchmark").select("item_id", token).withColumn("q_weight", F.lit(1.0))
    return R.sparse_top_k(postings, questions, 5, "row", "item_id").select("item_id", F.col("row").alias("doc_id"), "score", "rank")


@query(
    "weight_sweep",
    _SCORED
    + """, w AS (SELECT unnest([1.0, 1.0, 0.0]) AS w_dense, unnest([0.0, 0.05, 1.0]) AS w_sparse),
c AS (SELECT qid, w_dense, w_sparse, doc_id, round(w_dense * dense + w_sparse * sparse, 6) AS score FROM s, w),
r AS (SELECT *, row_number() OVER (PARTITION BY qid, w_dense, w_sparse ORDER BY score DESC, doc_id) AS rank FROM c)
SELECT qid, CAST(w_dense AS DOUBLE) AS w_dense, CAST(w_sparse AS DOUBLE) AS w_sparse, doc_id, CAST(score AS DOUBLE) AS score, rank FROM r WHERE rank <= 5""",
)
def weight_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query scored once, ranked for each setting."""
    rows = R.hybrid_top_k(text_blocks(spark, sf_dir), query_blocks(spark, sf_dir), [(1.0, 0.0), (1.0, 0.05), (0.0, 1.0)], 5)
    return rows.select("qid", "w_dense", "w_sparse", F.col("row").alias("doc_id"), "score", "rank")


@query(
    "multi_entity_interleave",
    f"""WITH q AS (SELECT vec_id AS qid, embedding FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT q.qid, vec_id, label, round({_DOT}, 6) AS score FROM embeddings e, q WHERE label IN (1, 2, 3)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY score DESC, vec_id) AS rank FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank, label) AS position FROM r WHERE rank <= 3)
SELECT qid, position, label, vec_id, score, rank FROM p WHERE position <= 8""",
)
def multi_entity_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.text_blocks(table(spark, sf_dir, "embeddings").filter(F.col("label").isin(1, 2, 3)), "vec_id", "label")
    each = R.hybrid_top_k(rows, query_blocks(spark, sf_dir), [(1.0, 0.0)], None, R.entity_quota(8, 3))
    each = each.select("qid", F.col("row").alias("vec_id"), F.col("group").cast("int").alias("label"), "score", "rank")
    return R.interleave(each, 8, "label", by=["qid"]).select("qid", "position", "label", "vec_id", "score", "rank")


for _name, _drop, _where in (("mask_latest_and_company", False, "label = 3 AND NOT old"), ("mask_company_drops_latest", True, "label = 3")):

    @query(_name, f"""WITH m AS (SELECT vec_id, label, vec_id < max(vec_id) OVER (PARTITION BY label, vec_id % 7) AS old FROM embeddings) SELECT vec_id, label FROM m WHERE {_where}""")
    def _mask(spark: SparkSession, sf_dir: str, drop: bool = _drop) -> DataFrame:
        rows = table(spark, sf_dir, "embeddings").withColumn("k", F.col("vec_id") % 7)
        rows = R.superseded(rows, ["label", "k"], "vec_id")
        return rows.filter(R.hard_filter(company=F.col("label") == 3, latest=~F.col("is_superseded"), company_drops_latest=drop)).select("vec_id", "label")


@query(
    "per_doc_cap",
    """WITH r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS n FROM documents)
SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank, doc_id, source, n_chars FROM r WHERE n <= 2 ORDER BY n_chars DESC, doc_id LIMIT 25""",
)
def per_doc_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.capped_top_k(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), 25, 2, "source", "doc_id", "n_chars").select("rank", "doc_id", "source", "n_chars")


@query(
    "superseded_latest",
    """SELECT o_orderkey, o_custkey, o_orderpriority, (o_orderpriority <> '5-LOW') AND coalesce(o_orderkey < max(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END) OVER (PARTITION BY o_custkey, o_orderpriority), false) AS is_superseded FROM orders""",
)
def superseded_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return R.superseded(rows, ["o_custkey", "o_orderpriority"], "o_orderkey", F.col("o_orderpriority") != "5-LOW")


@query(
    "entity_detect",
    """WITH RECURSIVE n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 2) FROM part),
q AS (SELECT item_id, replace(replace(text, ' the ', ' small ring과 '), ' of ', ' xlarge bolt의 ring ') AS text FROM benchmark),
c AS (SELECT item_id, name, CAST(instr(text, name) AS BIGINT) AS pos, length(name) AS len FROM q JOIN n ON name <> '' AND contains(text, name)),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY len DESC, pos, name) AS k FROM c),
f AS (SELECT DISTINCT item_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(a BIGINT, e BIGINT, name VARCHAR)[]) AS taken FROM o
      UNION ALL SELECT f.item_id, o.k, CASE WHEN len(list_filter(taken, lambda x: x.a < o.pos + o.len AND o.pos < x.e)) = 0 THEN list_append(taken, {'a': o.pos, 'e': o.pos + o.len, 'name': o.name}) ELSE taken END
      FROM f JOIN o ON o.item_id = f.item_id AND o.k = f.k + 1),
l AS (SELECT item_id, arg_max(taken, k) AS taken FROM f GROUP BY 1), u AS (SELECT item_id, unnest(taken) AS x FROM l)
SELECT item_id, x.name AS entity, x.a AS "at" FROM u""",
)
def entity_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts that name parts, some with particles or within a word and some inside longer names: frequent words are replaced, so that there is something to find."""
    q = table(spark, sf_dir, "benchmark").select("item_id", F.replace(F.replace("text", F.lit(" the "), F.lit(" small ring과 ")), F.lit(" of "), F.lit(" xlarge bolt의 ring ")).alias("text"))
    p = table(spark, sf_dir, "part")
    names = p.select(F.col("p_name").alias("name")).union(p.select(F.split_part("p_name", F.lit(" "), F.lit(2)))).distinct()
    return R.detect_entities(q, names, "item_id", "text", "name")


@query(
    "retrieval_metrics",
    """WITH p AS (SELECT doc_id, lang, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) AS token FROM documents),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) AS token FROM benchmark),
s AS (SELECT item_id, doc_id, lang, count(*) AS score FROM p JOIN q USING (token) GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s),
h AS (SELECT item_id, rank, CASE WHEN item_id % 5 <> 4 THEN lang = 'fr' END AS ok FROM r WHERE rank <= 5),
m AS (SELECT item_id, CASE WHEN count(ok) > 0 THEN CAST(coalesce(bool_or(ok AND rank = 1), false) AS INT) END AS hit_1,
             CASE WHEN count(ok) > 0 THEN CAST(coalesce(bool_or(ok), false) AS INT) END AS hit_k,
             CASE WHEN count(ok) > 0 THEN coalesce(1.0 / min(CASE WHEN ok THEN rank END), 0) END AS mrr FROM h GROUP BY 1)
SELECT round(avg(hit_1), 6) AS hit_1, count(hit_1) AS n_hit_1, round(avg(hit_k), 6) AS hit_k, count(hit_k) AS n_hit_k, round(avg(mrr), 6) AS mrr, count(mrr) AS n_mrr FROM m""",
)
def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with no expectation (every fifth) have null metrics, which means skip."""
    hits = sparse_topk(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    hits = hits.withColumn("ok", F.when(F.col("item_id") % 5 != 4, F.col("lang") == "fr"))
    found = R.means(R.metrics(hits, ["item_id"], 5), ["hit_1", "hit_k", "mrr"])
    return found.select(*[F.round(c, 6).alias(c) if not c.startswith("n_") else F.col(c) for c in found.columns])


@query(
    "entity_coverage",
    """WITH g AS (SELECT conv_id, list(DISTINCT role) AS found FROM conversations GROUP BY 1)
SELECT conv_id, CAST(len(list_intersect(found, ['user', 'assistant', 'system'])) AS DOUBLE) / 3 AS coverage FROM g""",
)
def entity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("found"))
    return g.select("conv_id", R.entity_coverage(F.array(F.lit("user"), F.lit("assistant"), F.lit("system")), F.col("found")).alias("coverage"))


@query(
    "vector_health",
    """WITH n AS (SELECT embedding, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS l FROM embeddings)
SELECT count(*) AS n, count(*) FILTER (len(embedding) <> 64) AS wrong_dim, count(*) FILTER (len(list_filter(embedding, lambda x: isnan(x))) > 0) AS not_finite,
       count(*) FILTER (l < 1e-6) AS zero, count(*) FILTER (abs(l - 1) > 1e-3) AS not_unit, round(min(l), 6) AS least_norm, round(max(l), 6) AS greatest_norm FROM n""",
)
def vector_health_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = vector_health(table(spark, sf_dir, "embeddings"), "embedding", 64)
    return h.withColumn("least_norm", F.round("least_norm", 6)).withColumn("greatest_norm", F.round("greatest_norm", 6))


@query("vector_norms", "SELECT vec_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm FROM embeddings")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(norm(F.col("embedding")), 6).alias("norm"))

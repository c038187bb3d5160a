"""Queries of state in document order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.operators import windows as W

from .registry import query, table

#: The lines of documents as blocks: a line of one to three words is a heading, its level is its number of words.
_LINES = r"""
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS seq, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
b AS (SELECT doc_id, CAST(seq AS BIGINT) AS seq, line, CASE WHEN len(string_split(line, ' ')) <= 3 THEN CAST(len(string_split(line, ' ')) AS INT) END AS level FROM l)
"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line")).withColumn("seq", F.col("seq").cast("long"))
    n = F.size(F.split("line", " "))
    return rows.withColumn("level", F.when(n <= 3, n))


@query(
    "section_path",
    _LINES
    + """, h AS (SELECT *, count(level) OVER w AS i FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
n AS (SELECT *, CASE WHEN level IS NOT NULL THEN i + least(0, min(CASE WHEN level IS NOT NULL THEN level - i END) OVER (PARTITION BY doc_id ORDER BY seq)) END AS len_ FROM h),
p AS (SELECT *, last_value(len_ IGNORE NULLS) OVER w AS d, last_value(CASE WHEN len_ = 1 THEN line END IGNORE NULLS) OVER w AS p1,
             last_value(CASE WHEN len_ = 2 THEN line END IGNORE NULLS) OVER w AS p2, last_value(CASE WHEN len_ = 3 THEN line END IGNORE NULLS) OVER w AS p3
      FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY seq))
SELECT doc_id, seq, CASE WHEN coalesce(d, 0) = 0 THEN '' WHEN d = 1 THEN p1 WHEN d = 2 THEN p1 || ' > ' || p2 ELSE p1 || ' > ' || p2 || ' > ' || p3 END AS path FROM p""",
)
def section_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.section_path(lines(spark, sf_dir), ["doc_id"], "seq", F.col("level"), F.col("line"))
    return rows.select("doc_id", "seq", F.array_join("path", " > ").alias("path"))


@query(
    "carry_forward_reset",
    _LINES
    + """, s AS (SELECT *, count(level) OVER (PARTITION BY doc_id ORDER BY seq) AS section FROM b)
SELECT doc_id, seq, section, last_value(CASE WHEN contains(line, 'ou') THEN length(line) END IGNORE NULLS) OVER (PARTITION BY doc_id, section ORDER BY seq) AS unit FROM s""",
)
def carry_forward_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).withColumn("section", W.section_number(["doc_id"], "seq", F.col("level").isNotNull()))
    unit = F.when(F.contains("line", F.lit("ou")), F.length("line").cast("long"))
    return rows.select("doc_id", "seq", "section", W.carried(unit, ["doc_id", "section"], "seq").alias("unit"))


@query(
    "text_islands",
    _LINES
    + """, i AS (SELECT *, count(level) OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM b)
SELECT doc_id, island, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n_blocks, sha256(string_agg(line, chr(10) ORDER BY seq)) AS text_sha FROM i WHERE level IS NULL GROUP BY 1, 2""",
)
def text_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.text_islands(lines(spark, sf_dir), ["doc_id"], "seq", F.col("level").isNull(), F.col("line"))
    return rows.select("doc_id", "island", "first_seq", "last_seq", "n_blocks", F.sha2("text", 256).alias("text_sha"))


@query(
    "split_40",
    """WITH o AS (SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS pos, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
SELECT l_suppkey, CAST(pos // 40 AS BIGINT) AS piece, count(*) AS n_rows, sum(l_orderkey)::BIGINT AS keys,
       CASE WHEN max(n) > 40 THEN (pos // 40 * 40 + 1)::VARCHAR || '-' || least(max(n), pos // 40 * 40 + 40)::VARCHAR END AS note FROM o GROUP BY l_suppkey, pos // 40""",
)
def split_40(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.row_pieces(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return rows.groupBy("l_suppkey", "piece").agg(F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("keys"), F.max("note").alias("note"))


@query(
    "attach_direction",
    """WITH n AS (SELECT conv_id, turn, role, lag(role) OVER w AS b, lead(role) OVER w AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
k AS (SELECT *, CASE role WHEN 'system' THEN 'unit' WHEN 'user' THEN 'footnote' END AS kind, coalesce(b = 'assistant', false) AS pr, coalesce(a IN ('assistant', 'user'), false) AS nx FROM n)
SELECT conv_id, turn, kind, CASE WHEN kind = 'unit' THEN CASE WHEN nx THEN 'next' WHEN pr THEN 'prev' END WHEN kind = 'footnote' THEN CASE WHEN pr THEN 'prev' WHEN nx THEN 'next' END END AS direction FROM k""",
)
def attach_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = W.neighbours(F.col("role"), ["conv_id"], "turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce(before == "assistant", F.lit(False)).alias("pr"), F.coalesce(after.isin("assistant", "user"), F.lit(False)).alias("nx"))
    rows = rows.withColumn("kind", F.when(F.col("role") == "system", "unit").when(F.col("role") == "user", "footnote"))
    return rows.select("conv_id", "turn", "kind", W.attach_direction(F.col("kind"), F.col("pr"), F.col("nx")).alias("direction"))


@query(
    "sibling_neighbours",
    """SELECT conv_id, turn, lag(role) OVER w AS before_role, lead(role) OVER w AS after_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def sibling_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = W.neighbours(F.col("role"), ["conv_id"], "turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", before.alias("before_role"), after.alias("after_role"))


@query(
    "interval_compress",
    """WITH d AS (SELECT DISTINCT o_custkey % 50 AS shard, o_orderkey FROM orders WHERE o_orderstatus <> 'F'),
k AS (SELECT *, o_orderkey - row_number() OVER (PARTITION BY shard ORDER BY o_orderkey) AS k FROM d)
SELECT shard, min(o_orderkey) AS start, max(o_orderkey) AS "end" FROM k GROUP BY shard, k""",
)
def interval_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus != 'F'").select((F.col("o_custkey") % 50).alias("shard"), "o_orderkey")
    return W.intervals(rows, "o_orderkey", ["shard"])


@query("interval_expand", "SELECT DISTINCT o_custkey % 50 AS shard, o_orderkey AS number FROM orders WHERE o_orderstatus <> 'F'")
def interval_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.expand(interval_compress(spark, sf_dir))


@query(
    "token_budget_batches",
    """WITH RECURSIVE c AS (SELECT source, doc_id // 4096 AS shard, doc_id, CAST(ceil(strlen(text) / 3.0) AS DOUBLE) AS cost FROM documents),
d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source, shard ORDER BY cost, doc_id) AS k FROM c),
f AS (SELECT source, shard, doc_id, cost, k, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS n, cost AS most FROM d WHERE k = 1
      UNION ALL SELECT d.source, d.shard, d.doc_id, d.cost, d.k, CASE WHEN greatest(most, d.cost) * (n + 1) > 16384 THEN batch + 1 ELSE batch END, CASE WHEN greatest(most, d.cost) * (n + 1) > 16384 THEN 1 ELSE n + 1 END,
             CASE WHEN greatest(most, d.cost) * (n + 1) > 16384 THEN d.cost ELSE greatest(most, d.cost) END FROM f JOIN d ON d.source = f.source AND d.shard = f.shard AND d.k = f.k + 1)
SELECT source, shard, doc_id, cost, batch FROM f""",
)
def token_budget_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source in greedy batches by length; a source may be cut into shards of ids, each batched by itself."""
    rows = table(spark, sf_dir, "documents").select("source", F.floor(F.col("doc_id") / 4096).alias("shard"), "doc_id", F.ceil(F.octet_length("text") / 3.0).cast("double").alias("cost"))
    return W.budget_batches(rows, "cost", 16384, ["source", "shard"], ["cost", "doc_id"], "source string, shard long, doc_id long, cost double, batch long")


@query(
    "dup_key_suffix",
    """WITH n AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)
SELECT event_id, user_id, CASE WHEN n = 1 THEN event_type ELSE event_type || '#' || n END AS key FROM n""",
)
def dup_key_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", W.numbered_keys(F.col("event_type"), ["user_id"], "event_id").alias("key"))


@query("last_write_wins", """SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.last_wins(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"])


@query("first_write_wins", """SELECT user_id, event_type, arg_min(event_id, event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2""")
def first_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.first_wins(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"])


@query(
    "ordered_distinct",
    """WITH f AS (SELECT user_id, event_type, min(event_id) AS e0 FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type, ',' ORDER BY e0) AS types FROM f GROUP BY 1""",
)
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("at"))
    return first.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "event_type"))), lambda x: x["event_type"]), ",").alias("types"))


@query(
    "running_labels",
    """WITH o AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1 AS fresh FROM conversations)
SELECT conv_id, turn, CAST(count(*) FILTER (fresh) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS n_labels FROM o""",
)
def running_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", W.gathered_count(F.col("role"), ["conv_id"], "turn").alias("n_labels"))


@query(
    "running_lists",
    """WITH f AS (SELECT conv_id, role, min(turn) AS at FROM conversations GROUP BY 1, 2)
SELECT c.conv_id, c.turn, string_agg(f.role, ',' ORDER BY f.at) AS roles FROM conversations c JOIN f ON f.conv_id = c.conv_id AND f.at <= c.turn GROUP BY 1, 2""",
)
def running_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.gathered(table(spark, sf_dir, "conversations"), F.array("role"), ["conv_id"], "turn").select("conv_id", "turn", F.array_join("gathered", ",").alias("roles"))


@query(
    "rank_functions",
    """SELECT c_custkey, rank() OVER w AS r, dense_rank() OVER w AS d, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS quarter, round(sum(c_acctbal) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS near
FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_nationkey)""",
)
def rank_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, o = Window.partitionBy("c_mktsegment").orderBy("c_nationkey"), Window.partitionBy("c_mktsegment").orderBy("c_acctbal", "c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"), F.ntile(4).over(o).cast("long").alias("quarter"), F.round(F.sum("c_acctbal").over(o.rowsBetween(-2, 0)), 2).alias("near"))

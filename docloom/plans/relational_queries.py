"""Queries of filters, joins, aggregates and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import scalars as S
from docloom.operators import documents as D
from docloom.operators import joins as J
from docloom.operators import quantiles as Q
from docloom.operators import retrieval as R
from docloom.operators import statements as ST

from .registry import query, table


@query("like_filter", "SELECT p_partkey, p_name, p_brand FROM part WHERE contains(p_name, 'ring') AND p_brand = 'Brand#2'")
def like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(R.company_filter(F.col("p_name"), F.col("p_partkey").cast("string"), "ring") & (F.col("p_brand") == "Brand#2")).select("p_partkey", "p_name", "p_brand")


@query("hard_filters", "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 2, 3)")
def hard_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = R.hard_filter(groups=("BUILDING", "MACHINERY"), years=(1, 2, 3), group="c_mktsegment", year="c_nationkey")
    return table(spark, sf_dir, "customer").filter(f).select("c_custkey", "c_mktsegment", "c_nationkey")


@query(
    "manifest_left_status",
    "SELECT c_custkey, n, CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey)",
)
def manifest_left_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return J.with_status(table(spark, sf_dir, "customer").select("c_custkey"), n, "c_custkey")


@query(
    "index_4way",
    """SELECT o_orderkey, c_custkey, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def index_4way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimensions are broadcast by Spark while they are under its size limit."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return rows.select("o_orderkey", "c_custkey", "n_name", "r_name")


@query("orphans_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def orphans_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("skiplist_anti", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def skiplist_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id", "left_anti")


@query(
    "multi_key_lookup",
    """WITH q AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR END AS k1, 'Customer#' || lpad((s_suppkey % 40)::VARCHAR, 9, '0') AS k2 FROM supplier),
a AS (SELECT c_custkey::VARCHAR AS id, max(c_nationkey) AS v FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1), b AS (SELECT c_name, max(c_nationkey) AS v FROM customer GROUP BY 1)
SELECT s_suppkey, coalesce(a.v, b.v) AS found, CASE WHEN a.v IS NOT NULL THEN 'id' WHEN b.v IS NOT NULL THEN 'c_name' END AS found_by FROM q LEFT JOIN a ON k1 = id LEFT JOIN b ON k2 = c_name""",
)
def multi_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").select(F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey").cast("string")).alias("id"), "c_name", "c_nationkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey")
    keys = [(F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey").cast("string")), "id"), (F.concat(F.lit("Customer#"), F.lpad((F.col("s_suppkey") % 40).cast("string"), 9, "0")), "c_name")]
    return J.lookup_cascade(rows, known, keys, "c_nationkey")


@query(
    "regression_full_outer",
    """WITH b AS (SELECT doc_id AS k, substr(sha1(text), 1, 16) AS h FROM documents), c AS (SELECT doc_id + 10 AS k, substr(sha1(text), 1, 16) AS h FROM documents)
SELECT k, CASE WHEN b.h IS NULL THEN 'NEW' WHEN c.h IS NULL THEN 'MISSING' WHEN b.h <> c.h THEN 'FAIL' ELSE 'PASS' END AS status FROM b FULL JOIN c USING (k)""",
)
def regression_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), S.short_sha1(F.col("text")).alias("h"))
    return J.regression(h, h.withColumn("k", F.col("k") + 10), "k", "h")


@query(
    "longest_prefix_join",
    """WITH u AS (SELECT page_id, url FROM pages), p AS (SELECT DISTINCT substr(url, 1, n) AS prefix FROM pages, (VALUES (10), (14), (18), (22)) t(n) WHERE contains(url, '/fr/')),
m AS (SELECT page_id, url, prefix, row_number() OVER (PARTITION BY page_id ORDER BY length(prefix) DESC) AS n FROM u JOIN p ON starts_with(url, prefix))
SELECT u.page_id, prefix, CASE WHEN prefix IS NOT NULL THEN trim(substr(u.url, length(prefix) + 1)) END AS qualifier FROM u LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (page_id)""",
)
def longest_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, lengths = table(spark, sf_dir, "pages").select("page_id", "url"), (10, 14, 18, 22)
    known = pages.filter(F.contains("url", F.lit("/fr/"))).select(F.explode(F.transform(F.array(*map(F.lit, lengths)), lambda n: F.substring("url", F.lit(1), n))).alias("prefix")).distinct()
    return J.longest_prefix(pages, "url", known, "prefix", ["page_id"], lengths).select("page_id", "prefix", "qualifier")


@query(
    "reconcile_fields",
    """WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders), b AS (SELECT o_orderkey + 1 AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders)
SELECT k, field, l AS "left", r AS "right" FROM (SELECT k, 's' AS field, a.s AS l, b.s AS r FROM a JOIN b USING (k) UNION ALL SELECT k, 'p', a.p, b.p FROM a JOIN b USING (k)) WHERE l IS DISTINCT FROM r""",
)
def reconcile_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    return J.reconcile(a, a.withColumn("k", F.col("k") + 1), "k", ["s", "p"])


@query(
    "facts_containment",
    """WITH f AS (SELECT DISTINCT c_nationkey AS g, substr(c_name, 1, 9 + c_custkey % 10) AS v FROM customer), x AS (SELECT c_nationkey AS g, c_name AS w FROM customer)
SELECT g, v, CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.g = f.g AND w = v) THEN 'exact' WHEN EXISTS (SELECT 1 FROM x WHERE x.g = f.g AND contains(w, v)) THEN 'inside' ELSE 'missing' END AS how FROM f""",
)
def facts_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    facts = c.select(F.col("c_nationkey").alias("g"), F.substring("c_name", F.lit(1), (9 + F.col("c_custkey") % 10).cast("int")).alias("v")).distinct()
    return J.containment(facts, c.select(F.col("c_nationkey").alias("g"), F.col("c_name").alias("v")), ["g"], "v")


@query(
    "rollup_census",
    """SELECT coalesce(event_type, '(all)') AS event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, round(sum(value), 2) AS total, count(*) FILTER (value > 50) AS n_high FROM events GROUP BY ROLLUP (event_type)""",
)
def rollup_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "events").rollup("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"), F.round(F.sum("value"), 2).alias("total"), F.count_if(F.col("value") > 50).alias("n_high"))
    return r.withColumn("event_type", F.coalesce("event_type", F.lit("(all)")))


@query(
    "pivot_rule_group",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS f, count(*) FILTER (l_linestatus = 'O') AS o, count(*) AS total FROM lineitem GROUP BY 1""",
)
def pivot_rule_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.count(F.lit(1))).na.fill(0)
    return p.select("l_returnflag", F.col("F").alias("f"), F.col("O").alias("o"), (F.col("F") + F.col("O")).alias("total"))


@query(
    "cube_sets",
    """SELECT coalesce(l_returnflag, '*') AS flag, coalesce(l_linestatus, '*') AS status, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def cube_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))
    return c.select(F.coalesce("l_returnflag", F.lit("*")).alias("flag"), F.coalesce("l_linestatus", F.lit("*")).alias("status"), "n", "qty")


@query(
    "fact_key_stats",
    """SELECT l_suppkey, count(*) AS n, count(DISTINCT l_returnflag) AS n_codes, count(DISTINCT (l_orderkey, l_returnflag)) AS n_triples, count(DISTINCT (l_orderkey, l_linenumber, l_returnflag)) AS n_quads,
count(*) - count(DISTINCT (l_orderkey, l_returnflag)) AS n_repeats, round_even(1 - count(DISTINCT l_returnflag)::DOUBLE / count(*), 6) AS lost_by_code, round_even(1 - count(DISTINCT (l_orderkey, l_returnflag))::DOUBLE / count(*), 6) AS lost_by_triple FROM lineitem GROUP BY 1""",
)
def fact_key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.key_statistics(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag", ["l_orderkey"], "l_linenumber")


@query(
    "facts_by_row",
    """SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS label, string_agg(o_orderkey || '=' || o_orderstatus, ',' ORDER BY o_orderkey) AS cells FROM orders GROUP BY 1""",
)
def facts_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = ST.facts_by_row(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_orderstatus", "o_orderstatus")
    return r.select("o_custkey", "label", F.array_join(F.transform("cells", lambda c: F.concat(c["o_orderkey"].cast("string"), F.lit("="), c["o_orderstatus"])), ",").alias("cells"))


@query(
    "linear_identity",
    """WITH r AS (SELECT l_suppkey AS g, l_returnflag AS c, sum(l_quantity) AS t, sum(l_quantity) FILTER (l_linestatus = 'F') AS f, sum(l_quantity) FILTER (l_linestatus = 'O') AS o FROM lineitem GROUP BY 1, 2)
SELECT g AS "group", c AS "column", t AS total, f + o + (CASE WHEN g % 10 = 0 THEN 5 ELSE 0 END) AS "sum", CASE WHEN g % 10 = 0 THEN 'fail' ELSE 'pass' END AS status FROM r WHERE f IS NOT NULL AND o IS NOT NULL""",
)
def linear_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities by status must add up to the whole; every tenth supplier's are made wrong by five."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("t"), F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))).alias("f"), F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("o"))
    wrong = F.col("f") + F.when(F.col("l_suppkey") % 10 == 0, 5).otherwise(0)
    cell = lambda label, row, value: F.struct(F.lit(label).alias("label"), F.lit(row).alias("row"), value.alias("value"))
    cells = F.explode(F.array(cell("Total", 0, F.col("t")), cell("Filled", 1, wrong), cell("Open", 2, F.col("o"))))
    rows = g.select(F.col("l_suppkey").alias("group"), F.col("l_returnflag").alias("column"), F.lit("X").alias("statement"), cells.alias("x")).select("group", "column", "statement", "x.*")
    terms = ST.rule_terms(spark, [("X", "total", "total", [(+1, "filled"), (+1, "open")], [], None)], {"total": ["Total"], "filled": ["Filled", "Shipped"], "open": ["Open"]})
    return ST.identities(rows, terms).select("group", "column", "total", "sum", "status")


@query(
    "column_total",
    """WITH s AS (SELECT user_id, sum(value) FILTER (event_type = 'click') AS a, sum(value) FILTER (event_type = 'error') AS b, sum(value) FILTER (event_type IN ('click', 'error')) AS t FROM events GROUP BY 1)
SELECT user_id, CASE WHEN a IS NOT NULL OR b IS NOT NULL OR t IS NOT NULL THEN abs(coalesce(t, 0) - coalesce(a, 0) - coalesce(b, 0)) <= 1 END AS holds FROM s""",
)
def column_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = lambda *k: F.sum(F.when(F.col("event_type").isin(*k), F.col("value")))
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(own("click").alias("a"), own("error").alias("b"), own("click", "error").alias("t"))
    return s.select("user_id", ST.column_total(F.array("a", "b", "t")).alias("holds"))


@query(
    "confidence_grade",
    """WITH s AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_totalprice > 450000) AS bad, max(o_orderpriority) AS u, bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN bad > 0 OR u < '4' OR NOT p THEN 'low' WHEN n - 10 <= 0 THEN 'unverified' ELSE 'high' END AS grade,
 concat_ws(',', CASE WHEN bad > 0 THEN 'checks failed' END, CASE WHEN u < '4' THEN 'no unit' END, CASE WHEN NOT p THEN 'no periods' END, CASE WHEN greatest(n - 10, 0) = 0 THEN 'nothing checked' END) AS reasons FROM s""",
)
def confidence_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 450000).alias("bad"), F.max("o_orderpriority").alias("u"), F.bool_or(F.col("o_orderstatus") == "P").alias("p"))
    c = ST.confidence(F.greatest(F.col("n") - 10, F.lit(0)), F.col("bad"), F.col("u") >= "4", F.col("p"))
    return s.withColumn("c", c).select("o_custkey", F.col("c.grade").alias("grade"), F.array_join("c.reasons", ",").alias("reasons"))


@query(
    "corrections_pairs",
    """WITH p AS (SELECT o_orderkey, o_orderstatus AS b, lead(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS a, o_orderpriority FROM orders)
SELECT o_orderkey, trim(o_orderpriority) AS item, b AS "before", a AS "after", b <> coalesce(a, '') AS changed FROM p""",
)
def corrections_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("before"), F.lead("o_orderstatus").over(w).alias("after"), "o_orderpriority")
    return ST.corrections(t, "before", "after", "o_orderpriority").select("o_orderkey", "item", "before", "after", "changed")


@query(
    "percentile_linear",
    """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.9) AS p90, quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY 1""",
)
def percentile_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.percentiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query(
    "upper_median",
    """WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, max(n_chars) FILTER (i = n // 2 + 1) AS median FROM r GROUP BY 1""",
)
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.order_statistics(table(spark, sf_dir, "documents"), ["lang"], "n_chars", {"median": F.floor(F.col("n") / 2)})


@query(
    "topk_values",
    """WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS rank FROM c) SELECT lang, source, n, rank FROM r WHERE rank <= 15""",
)
def topk_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_k_each(table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n")), ["lang"], 15, "source", "n")


@query(
    "reservoir_by_hash",
    """WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '-7'), doc_id) AS n FROM documents) SELECT lang, doc_id FROM r WHERE n <= 10""",
)
def reservoir_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed sample of each group: the smallest hashes."""
    w = Window.partitionBy("lang").orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("-7")).cast("binary")), "doc_id")
    return table(spark, sf_dir, "documents").select("lang", "doc_id", F.row_number().over(w).alias("n")).filter("n <= 10").drop("n")


@query(
    "alias_sets",
    """SELECT p_brand, string_agg(n, '|' ORDER BY n) AS names FROM (SELECT DISTINCT p_brand, p_name AS n FROM part UNION SELECT DISTINCT p_brand, p_type FROM part) GROUP BY 1""",
)
def alias_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    both = p.select("p_brand", F.col("p_name").alias("n")).union(p.select("p_brand", "p_type"))
    return D.alias_sets(both, "p_brand", "n").select("p_brand", F.array_join("aliases", "|").alias("names"))


@query("set_ops_receipts", """SELECT o_custkey AS k, 'both' AS part FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT o_custkey, 'only' FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def set_ops_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    a, b = (o.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in ("O", "F"))
    return a.intersect(b).withColumn("part", F.lit("both")).union(a.exceptAll(b).distinct().join(b, "k", "left_anti").withColumn("part", F.lit("only")))


@query("shard_union", "SELECT shard, count(*) AS n, min(o_orderkey) AS first_key FROM (SELECT 0 AS shard, o_orderkey FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 1, o_orderkey FROM orders WHERE o_orderkey % 2 = 1) GROUP BY 1")
def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    shards = [o.filter(F.col("o_orderkey") % 2 == i).select(F.lit(i).alias("shard"), "o_orderkey") for i in (0, 1)]
    return shards[0].unionByName(shards[1]).groupBy("shard").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query(
    "shard_bounds",
    """SELECT s_suppkey % 8 AS rank, min(c.n * (s_suppkey % 8) // 8) AS lo, min(c.n * (s_suppkey % 8 + 1) // 8) AS hi FROM supplier, (SELECT count(*) AS n FROM orders) c GROUP BY 1""",
)
def shard_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").agg(F.count("*").alias("n"))
    rows = n.select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("rank"))
    return rows.select("rank", F.floor(F.col("n") * F.col("rank") / 8).alias("lo"), F.floor(F.col("n") * (F.col("rank") + 1) / 8).alias("hi"))


@query(
    "contract_preflight",
    """SELECT count(*) AS n, count(*) FILTER (trim(text) = '') AS blank_text, count(*) FILTER (trim(source) = '') AS blank_source, count(doc_id) - count(DISTINCT doc_id) AS repeated_keys FROM documents""",
)
def contract_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.operators.checks import contract

    return contract(table(spark, sf_dir, "documents"), ["text", "source"], "doc_id")


@query("compaction", "SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) GROUP BY 1")
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").filter("quality = 0"), "doc_id", "left_anti")
    return kept.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "pricing_summary",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY 1, 2""",
)
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("date"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))

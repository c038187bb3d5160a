"""Queries of the document pipeline's steps: incremental work, indexes, forms, rendering, packages, as-of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import scalars as S
from docloom.operators import documents as D
from docloom.operators import forms, tables
from docloom.operators import joins as J
from docloom.operators import windows as W
from docloom.sources import files
from docloom.streaming import events as E

from .registry import query, table
from .window_queries import _LINES, lines


@query(
    "incremental_rebuild",
    """WITH d AS (SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS m, CASE WHEN o_orderpriority = '5-LOW' THEN 'old' ELSE 'new' END AS c FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey FROM orders LEFT JOIN d ON o_orderkey = k WHERE k IS NULL OR abs(o_totalprice - m) > 1e-6 OR c <> 'new'""",
)
def incremental_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    sources = o.select("o_orderkey", F.col("o_totalprice").alias("modified"), F.lit("new").alias("config_hash"))
    done = o.filter("o_orderstatus != 'F'").select("o_orderkey", (F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("modified"), F.when(F.col("o_orderpriority") == "5-LOW", "old").otherwise("new").alias("config_hash"))
    return E.to_rebuild(sources, done, "o_orderkey").select("o_orderkey")


@query(
    "resume_todo",
    """WITH t AS (SELECT o_orderkey AS n FROM orders EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'), k AS (SELECT n, n - row_number() OVER (ORDER BY n) AS k FROM t)
SELECT min(n) AS start, max(n) AS "end" FROM k GROUP BY k""",
)
def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to do as intervals: done ones are an anti-join. Blocks of numbers are compressed apart and met at their borders."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"), "o_orderstatus")
    todo = o.join(o.filter("o_orderstatus = 'O'").select("n"), "n", "left_anti")
    return W.whole_intervals(todo, "n", 4096)


@query("distinct_events", "SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events")
def distinct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    e = e.withColumn("key", F.concat_ws("|", "user_id", "event_type", F.col("hour").cast("string")))
    return E.distinct_events(e, "key", "hour").drop("key")


@query(
    "as_of_click",
    """WITH c AS (SELECT event_id, user_id, event_type, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS click_value FROM events)
SELECT event_id, user_id, click_value FROM c WHERE event_type <> 'click'""",
)
def as_of_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last click before it: an as-of join as one window over one exchange."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").withColumn("click_value", F.last(F.when(F.col("event_type") == "click", F.col("value")), True).over(w))
    return rows.filter("event_type != 'click'").select("event_id", "user_id", "click_value")


@query("events_sliding", """WITH s AS (SELECT unnest([0, 1, 2]) AS k) SELECT date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS start, count(*) AS n FROM events, s GROUP BY 1""")
def events_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.window("ts", "3 hours", "1 hour")
    return table(spark, sf_dir, "events").groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query(
    "document_index",
    _LINES
    + """, h AS (SELECT doc_id, line, min(seq) AS s FROM b WHERE level = 2 GROUP BY 1, 2), t AS (SELECT doc_id, string_agg(line, '|' ORDER BY s) AS toc FROM h GROUP BY 1), n AS (SELECT doc_id, count(*) AS n_blocks FROM b GROUP BY 1)
SELECT l.doc_id, coalesce(toc, '') AS toc, n_blocks FROM labels l LEFT JOIN t USING (doc_id) LEFT JOIN n USING (doc_id)""",
)
def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = lines(spark, sf_dir).select("doc_id", "seq", F.when(F.col("level").isNotNull(), "h").otherwise("p").alias("kind"), "level", F.col("line").alias("text"))
    rows = D.document_index(table(spark, sf_dir, "labels").select("doc_id"), blocks)
    return rows.select("doc_id", F.array_join("toc", "|").alias("toc"), "n_blocks")


@query(
    "period_dictionary",
    """WITH r AS (SELECT o_custkey, o_orderkey, o_orderkey % 3 + 1 AS k, o_orderstatus = 'F' AS f, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
d AS (SELECT o_custkey, k, arg_min(d, o_orderkey) AS begin FROM r WHERE NOT f GROUP BY 1, 2)
SELECT o_custkey, '제 ' || k || ' 기 1분기' || CASE WHEN f THEN ' 3개월' ELSE '' END AS label, count(*) AS n, begin, CASE WHEN f AND begin IS NOT NULL THEN '3개월' END AS qualifier
FROM r LEFT JOIN d USING (o_custkey, k) GROUP BY o_custkey, k, f, begin""",
)
def period_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a label and a date, and lines with a longer label and none."""
    o, number = table(spark, sf_dir, "orders"), (F.col("o_orderkey") % 3 + 1).cast("string")
    dated = F.concat(F.lit("매출 제 "), number, F.lit(" 기 1분기 "), F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit(" 현재"))
    text = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("제"), number, F.lit("기 1분기  3개월 매출액은 다음과 같다"))).otherwise(dated)
    rows = D.period_dictionary(o.select("o_custkey", F.col("o_orderkey").alias("seq"), text.alias("text")), "o_custkey", F.col("text"))
    return rows.select("o_custkey", F.regexp_replace("label", "^제 ?([0-9]) ?기", "제 $1 기").alias("label"), "n", F.col("period.begin").alias("begin"), "qualifier")


@query(
    "tagged_facts",
    """SELECT o_orderkey, 'STATUS' AS code, 'Status' AS labels, o_orderstatus AS value FROM orders UNION ALL SELECT o_orderkey, 'PRIORITY', 'Status|Priority', o_orderpriority FROM orders""",
)
def tagged_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts read back from forms written from orders."""
    form = F.concat(F.lit("<TABLE><TR><TD>Status<TE ACODE='STATUS'>"), "o_orderstatus", F.lit("</TE><TD>Priority</TD><TE ACODE='PRIORITY'>"), "o_orderpriority", F.lit("</TABLE>"))
    rows = forms.extract_facts(table(spark, sf_dir, "orders").select("o_orderkey", form.alias("s")), "o_orderkey", "s")
    return rows.select("o_orderkey", "code", F.array_join("labels", "|").alias("labels"), "value")


@query("form_values", "SELECT s_suppkey, 'Supplier > Name' AS field, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 'Supplier > Nation', s_nationkey::VARCHAR FROM supplier")
def form_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed values under a label that spans two rows."""
    form = F.concat(F.lit("<table><tr><td rowspan=2>Supplier</td><td>Name</td><te>"), "s_name", F.lit("</te></tr><tr><td>Nation</td><te>"), F.col("s_nationkey").cast("string"), F.lit("</te></tr></table>"))
    rows = forms.extract_values(table(spark, sf_dir, "supplier").select("s_suppkey", form.alias("s")), "s_suppkey", "s")
    return forms.field_view(rows, "s_suppkey")


@query(
    "markdown_tables",
    """SELECT n_regionkey, '| key | name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || ' |', chr(10) ORDER BY n_nationkey) || chr(10) AS markdown FROM nation GROUP BY 1""",
)
def markdown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.array(x["n_nationkey"].cast("string"), x["n_name"]))
    g = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(rows.alias("rows"))
    none = lambda kind: F.lit(None).cast(kind)
    blocks = g.select("n_regionkey", F.lit(0).alias("seq"), F.lit("t").alias("kind"), none("int").alias("level"), none("string").alias("text"), none("array<string>").alias("keys"), none("string").alias("value"), F.array(F.lit("key"), F.lit("name")).alias("headers"), "rows")
    return D.markdown(blocks, "n_regionkey")


@query(
    "package_verify",
    """SELECT doc_id AS path, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'mismatch' WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'missing' ELSE 'ok' END AS status FROM documents""",
)
def package_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.sha2("text", 256).alias("sha256"))
    found = docs.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("path"), "toxic"), "path")
    return files.verify_package(docs, found.select("path", F.when(F.col("toxic") == 1, F.lit("changed")).otherwise(F.col("sha256")).alias("sha256")))


@query(
    "header_columns",
    """SELECT o_custkey, count(*) + 1 AS n_rows, 'key|state' AS header, count(*) AS n_body FROM orders GROUP BY 1""",
)
def header_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose header spans two equal columns: the band is found by numbers and the doubled column goes."""
    body = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))), lambda x: F.array(x["o_orderkey"].cast("string"), x["o_orderkey"].cast("string"), x["o_orderstatus"], F.concat(F.lit("1"), x["o_orderkey"].cast("string"))))
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.concat(F.array(F.array(F.lit("key"), F.lit("key"), F.lit("state"), F.lit("state"))), F.transform(body, lambda r: F.array(r[0], r[1], r[3], r[3]))).alias("rows"))
    g = g.withColumn("live", tables.live_columns(F.col("rows"))).withColumn("n", tables.header_rows(F.col("live")))
    return g.select("o_custkey", F.size("rows").cast("long").alias("n_rows"), F.array_join(tables.merged_header(F.col("live"), F.col("n")), "|").alias("header"), F.size(tables.body(F.col("live"), F.col("n"))).cast("long").alias("n_body"))


@query(
    "caption_census",
    """WITH t AS (SELECT conv_id, turn, role, coalesce(lag(role) OVER w = 'assistant', false) AS b, coalesce(lead(role) OVER w = 'assistant', false) AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT CASE role WHEN 'system' THEN 'unit' ELSE 'footnote' END AS caption, count(*) AS total, count(*) FILTER (a AND NOT b) AS next_only, count(*) FILTER (b AND NOT a) AS prev_only, count(*) FILTER (a AND b) AS "both", count(*) FILTER (NOT a AND NOT b) AS neither, count(*) FILTER (a OR b) AS attached FROM t WHERE role <> 'assistant' GROUP BY 1""",
)
def caption_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as tables: an assistant's is a real one, others are captions."""
    text = F.when(F.col("role") == "system", "(단위 : 원)").when(F.col("role") == "user", "※ note")
    cell = lambda *x: F.array(*[F.lit(v) for v in x])
    rows = F.when(F.col("role") == "assistant", F.array(cell("a", "b"), cell("1", "2"))).otherwise(F.array(F.array(text)))
    judged = tables.judge_captions(table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("text"), rows.alias("rows")), ["conv_id"], "turn")
    return tables.caption_census(judged, [])


@query(
    "group_matrix",
    """SELECT coalesce(lang, '(all)') AS lang, count(*) AS n, count(DISTINCT source) AS n_sources, round_even(100.0 * count(*) FILTER (n_chars > 1600) / count(*), 2) AS long_percent FROM documents GROUP BY ROLLUP (lang)""",
)
def group_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "documents").rollup("lang").agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"), F.bround(100.0 * F.count_if(F.col("n_chars") > 1600) / F.count("*"), 2).alias("long_percent"))
    return r.withColumn("lang", F.coalesce("lang", F.lit("(all)")))


@query(
    "alias_candidates",
    """SELECT s_suppkey, '(주)' || s_name || '|' || s_name || '주식회사|' || s_name || ' Co., Ltd.|' || s_name AS names FROM supplier""",
)
def alias_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dressed = F.concat("s_name", F.lit(" Co., Ltd."))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(S.alias_candidates(dressed), "|").alias("names"))


@query(
    "source_comparison",
    """WITH a AS (SELECT p_partkey AS k, p_type AS v FROM part WHERE p_size <= 40), b AS (SELECT p_partkey AS k, CASE WHEN p_size > 30 THEN 'X' ELSE p_type END AS v FROM part WHERE p_size > 10)
SELECT k, CASE WHEN a.v IS NULL THEN 'NEW' WHEN b.v IS NULL THEN 'MISSING' WHEN a.v <> b.v THEN 'FAIL' ELSE 'PASS' END AS status FROM a FULL JOIN b USING (k)""",
)
def source_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    a = p.filter("p_size <= 40").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("v"))
    b = p.filter("p_size > 10").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") > 30, "X").otherwise(F.col("p_type")).alias("v"))
    return J.regression(a, b, "k", "v")

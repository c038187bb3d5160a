"""Queries of text, markup, chunks, policy and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import scalars as S
from docloom.operators import checks, chunks, policy, windows
from docloom.sources import markup

from .registry import query, table


@query("sha1_16", "SELECT doc_id, substr(sha1(text), 1, 16) AS sha FROM documents")
def sha1_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.short_sha1(F.col("text")).alias("sha"))


@query(
    "clean_flat",
    r"""SELECT doc_id, sha256(trim(regexp_replace(array_to_string(list_filter(list_transform(string_split(replace(text, chr(13), ''), chr(10)), lambda x: trim(regexp_replace(x, '[ \t]{2,}', ' ', 'g'))), lambda x: x <> ''), ' '), ' {2,}', ' ', 'g'))) AS flat_sha FROM documents""",
)
def clean_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(S.flat(F.col("text")), 256).alias("flat_sha"))


@query("number_parse", "SELECT event_id, value AS plain, -value AS negative, CAST(NULL AS DOUBLE) AS other FROM events")
def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_number("value", 2)
    return table(spark, sf_dir, "events").select("event_id", S.number(text).alias("plain"), S.number(F.concat(F.lit("("), text, F.lit(")"))).alias("negative"), S.number(F.concat(F.lit("△"), text)).alias("other"))


@query("iso_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS found, 'instant' AS kind FROM orders")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits, text = F.date_format("o_orderdate", "yyyyMMdd"), F.concat(F.lit("as of "), F.date_format("o_orderdate", "yyyy.M.d"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", S.iso_digits(digits).alias("iso"), S.period_of(text).alias("p"))
    return rows.select("o_orderkey", "iso", S.period_display(F.col("p")).alias("found"), F.col("p.kind").alias("kind"))


@query("legal_form_strip", "SELECT s_suppkey, s_name AS bare, replace(s_name, '#', '#') AS safe FROM supplier")
def legal_form_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    dressed = F.concat(F.lit("(주) "), F.col("s_name"), F.lit(" Co., Ltd."))
    return table(spark, sf_dir, "supplier").select("s_suppkey", S.strip_legal_form(dressed).alias("bare"), S.safe_filename(F.concat(F.col("s_name"), F.lit(" ."))).alias("safe"))


@query("bare_amp_count", r"SELECT page_id, length(html) - length(replace(html, '&', '')) - len(regexp_extract_all(html, '&(amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);')) AS n FROM pages")
def bare_amp_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", S.bare_ampersands(F.col("html")).cast("long").alias("n"))


@query(
    "policy_reconcile",
    r"""WITH c AS (SELECT page_id, length(html) - length(replace(html, '&', '')) - len(regexp_extract_all(html, '&(amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);')) AS e1,
 len(regexp_extract_all(html, '<([^/?!A-Za-z]|$)')) AS e2 FROM pages)
SELECT 'E1_bare_ampersand' AS rule, coalesce(sum(e1), 0)::BIGINT AS total, count(*) FILTER (e1 > 0) AS n_docs FROM c UNION ALL SELECT 'E2_bare_lt', coalesce(sum(e2), 0)::BIGINT, count(*) FILTER (e2 > 0) FROM c
UNION ALL SELECT 'E3_cp949_fallback', 0, 0 UNION ALL SELECT 'E4_library_container', 0, 0""",
)
def policy_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of the policy with their hits over raw pages; rules without hits stay."""
    rows = policy.apply_stage(table(spark, sf_dir, "pages").select("page_id", "html"), "html", policy.RULES, "sanitize")
    actions = rows.select("page_id", F.explode("actions").alias("a")).select("page_id", "a.rule", "a.count")
    return policy.summary(actions, policy.RULES, "page_id", "page_id").select("rule", "total", "n_docs")


@query("html_blocks")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.parse_blocks(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "seq", "kind", "level", "text")


@query("html_tree_profile")
def html_tree_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.tag_profile(markup.parse_nodes(table(spark, sf_dir, "pages"), "page_id", "html"), "page_id")


@query("html_paths")
def html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.path_counts(markup.parse_nodes(table(spark, sf_dir, "pages"), "page_id", "html"))


@query("page_chunks")
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = markup.parse_blocks(table(spark, sf_dir, "pages"), "page_id", "html")
    return chunks.build_chunks(blocks, "page_id").select("page_id", "chunk_id", "kind", F.array_join("section_path", " > ").alias("section"), "n_chars", "text")


@query("page_chunk_stats")
def page_chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = markup.parse_blocks(table(spark, sf_dir, "pages"), "page_id", "html")
    return chunks.chunk_statistics(chunks.build_chunks(blocks, "page_id"))


@query(
    "grid_expand",
    """SELECT l_orderkey, CAST(count(*) AS INT) AS n_rows, CAST(max(l_linenumber % 3 + 1) AS INT) AS n_cols, true AS rectangular FROM lineitem GROUP BY 1 HAVING max(l_linenumber % 3 + 1) > 1""",
)
def grid_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with spans, made from order lines, spread over their rectangle."""
    cell = F.concat(F.lit("<td colspan="), (F.col("l_linenumber") % 3 + 1).cast("string"), F.lit(">"), F.col("l_returnflag"), F.lit("</td>"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", cell.alias("c")))), lambda x: F.concat(F.lit("<tr>"), x["c"], F.lit("</tr>"))), "").alias("r"))
    t = markup.parse_blocks(rows.select("l_orderkey", F.concat(F.lit("<table>"), "r", F.lit("</table>")).alias("html")), "l_orderkey", "html").filter("kind = 't'")
    return t.select("l_orderkey", F.size("rows").alias("n_rows"), F.size(F.col("rows")[0]).alias("n_cols"), checks.rectangular(F.col("rows")).alias("rectangular"))


@query(
    "coverage_tokens",
    """WITH s AS (SELECT doc_id, lang, list_distinct(regexp_extract_all(text, '[가-힣]{3,}|[A-Za-z0-9][A-Za-z0-9.\\-]{2,}')) AS a, list_distinct(regexp_extract_all(lower(text), '[가-힣]{3,}|[A-Za-z0-9][A-Za-z0-9.\\-]{2,}')) AS b FROM documents)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_tokens, CAST(len(list_filter(a, lambda x: NOT list_contains(b, x))) AS BIGINT) AS n_lost FROM s""",
)
def coverage_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", S.coverage_tokens(F.col("text")).alias("a"), S.coverage_tokens(F.lower("text")).alias("b"))
    return rows.select("doc_id", F.size("a").cast("long").alias("n_tokens"), F.size(F.array_except("a", "b")).cast("long").alias("n_lost"))


@query("json_roundtrip", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS again FROM events""")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long").alias("j"))
    return rows.select("event_id", F.col("j.k").alias("k"), F.to_json("j").alias("again"))


@query(
    "chunk_stats",
    """SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars, round_even(avg(n_chars), 4) AS mean_chars, count(*) FILTER (n_chars > 1600) AS n_long, round_even(count(*) FILTER (n_chars > 1600)::DOUBLE / count(*), 4) AS long_share FROM documents GROUP BY 1""",
)
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = F.count_if(F.col("n_chars") > 1600)
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.bround(F.avg("n_chars"), 4).alias("mean_chars"), long.alias("n_long"), S.ratio(long, F.count("*")).alias("long_share"))


@query("events_tumbling", """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def events_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.streaming.events import tumbling

    return tumbling(table(spark, sf_dir, "events"), "1 hour", "event_type").select("start", "event_type", "n", F.round("total", 2).alias("total"))


@query(
    "events_session",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, session""",
)
def events_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts")
    gap = F.col("ts") - F.lag("ts").over(w)
    rows = table(spark, sf_dir, "events").select("user_id", "ts", F.when(gap <= F.expr("interval 30 minutes"), 0).otherwise(1).alias("new"))
    return rows.withColumn("session", F.sum("new").over(w)).groupBy("user_id", "session").agg(F.min("ts").alias("start"), F.count("*").alias("n")).drop("session")


@query("events_latest", "SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def events_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.last_wins(table(spark, sf_dir, "events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"])


@query(
    "captions_of_brands",
    """SELECT p_partkey, p_brand AS unit, 'unit' AS kind, CASE WHEN p_size % 2 = 0 THEN 'footnote' END AS note, CASE WHEN p_size % 3 = 0 THEN '' END AS empty FROM part""",
)
def captions_of_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions with blanks within the word, footnotes, and captions of nothing."""
    p = table(spark, sf_dir, "part")
    unit = F.concat(F.lit("표 ( 단 위 ： "), F.col("p_brand"), F.lit(" ) 계속"))
    note = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" ※ "), "p_name")).otherwise(F.col("p_name"))
    return p.select("p_partkey", S.caption_unit(unit).alias("unit"), S.caption_kind(unit).alias("kind"), S.caption_kind(note).alias("note"), S.caption_unit(F.when(F.col("p_size") % 3 == 0, F.lit("(단위 : )")).otherwise("p_name")).alias("empty"))


@query(
    "statement_codes",
    """WITH c AS (SELECT l_orderkey, l_linenumber, ['BS', 'IS', 'CF', 'EF', 'NT'][l_orderkey % 5 + 1] AS s, ['', '_S', '_C'][l_linenumber % 3 + 1] AS b, CASE WHEN l_quantity > 25 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN s <> 'NT' THEN s END AS statement, CASE WHEN s <> 'NT' THEN CASE WHEN b = '_S' THEN 'separate' ELSE 'consolidated' END END AS basis, CASE WHEN s <> 'NT' AND v <> '' THEN CAST(v AS INT) END AS variant, CASE WHEN s <> 'NT' THEN CASE WHEN b = '' THEN 'inferred_no_suffix' ELSE 'suffix' END END AS source FROM c""",
)
def statement_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    variant = F.when(F.col("l_quantity") > 25, F.col("l_linenumber").cast("string")).otherwise("")
    code = F.concat(F.lit("{XBRL}"), pick(("BS", "IS", "CF", "EF", "NT"), F.col("l_orderkey") % 5), pick(("", "_S", "_C"), F.col("l_linenumber") % 3), variant)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.statement_code(code).alias("c"))
    return rows.select("l_orderkey", "l_linenumber", "c.statement", "c.basis", "c.variant", F.col("c.basis_source").alias("source"))


@query(
    "labels_normal",
    """SELECT p_partkey, replace(p_name, ' ', '') AS label, p_name AS flat, 'small' AS kept FROM part""",
)
def labels_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered labels with a note reference, and text with characters that show nothing."""
    p = table(spark, sf_dir, "part")
    label = F.concat(F.lit("Ⅵ. 1) "), "p_name", F.lit(" (주 5,27) "))
    dirty = F.concat(F.lit(" \u200b"), F.replace("p_name", F.lit(" "), F.lit("\u00a0 \t")), F.lit("\x01\n\x0b "))
    return p.select("p_partkey", S.normal_label(label).alias("label"), S.flat(dirty).alias("flat"), S.normal_label(F.lit("small")).alias("kept"))


@query(
    "numbers_strict",
    """SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS plain, -CAST(o_orderkey AS DOUBLE) AS negative, CAST(NULL AS DOUBLE) AS suffixed, CAST(NULL AS DOUBLE) AS power, CAST(o_orderkey // 7 AS INT) AS whole, ceil(o_orderkey / 7.0)::BIGINT AS parts, ceil(o_orderkey / 3.0)::BIGINT AS tokens FROM orders""",
)
def numbers_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = F.format_number(key, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", S.number(F.concat(F.lit(" "), text)).alias("plain"), S.number(F.concat(F.lit("( "), text, F.lit(")"))).alias("negative"), S.number(F.concat(text, F.lit("d"))).alias("suffixed"), S.number(F.concat(key.cast("string"), F.lit("e1"))).alias("power"), S.whole(F.concat(F.lit(" "), F.floor(key / 7).cast("string")), 1).alias("whole"), S.ceil_div(key, F.lit(7)).alias("parts"), S.tokens_estimate(key).alias("tokens"))


@query(
    "period_labels",
    """WITH o AS (SELECT o_orderkey, o_orderkey % 60 + 1 AS k, ['', ' 1분기', ' 반기', ' 기말', ' 3분기말 누적'][o_orderkey % 5 + 1] AS s, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
SELECT o_orderkey, '제 ' || k || ' 기' || s AS body, '제 ' || k || ' 기' || s AS caption, d AS shown, d || ' ~ ' || d AS span, CAST(left(d, 4) AS INT) AS year, d || ' ~ ' || d AS unit_dates FROM o""",
)
def period_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in running text and before a date, dates, ranges and receipts."""
    number = (F.col("o_orderkey") % 60 + 1).cast("string")
    label = F.concat(F.lit("제 "), number, F.lit("  기"), F.element_at(F.array(*map(F.lit, ("", " 1분기", " 반기", " 기말", " 3분기말 누적"))), (F.col("o_orderkey") % 5 + 1).cast("int")))
    date, digits = F.date_format("o_orderdate", "yyyy.M.d"), F.date_format("o_orderdate", "yyyyMMdd")
    body, caption = F.concat(F.lit("당사의 "), label, F.lit(" 매출은 늘었다")), F.concat(label, F.lit(" "), date, F.lit(" 현재"))
    twice = F.concat(label, F.lit(" "), date, F.lit("부터 "), date, F.lit("까지"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.period_label(body).alias("body"), S.period_label(caption, caption=True).alias("caption"), S.period_display(S.period_of(caption)).alias("shown"), S.period_display(S.period_of(twice)).alias("span"), S.receipt_year(F.concat(digits, F.lit("000001"))).alias("year"), S.unit_value_dates(F.concat(digits, F.lit("-"), digits)).alias("unit_dates"))


@query(
    "turn_chunks",
    r"""WITH t AS (SELECT conv_id, turn, role, text, count(*) FILTER (role IN ('system', 'assistant')) OVER w AS run, count(*) FILTER (role = 'system') OVER w AS section FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
h AS (SELECT conv_id, section, 'T' || min(turn) AS title FROM t WHERE role = 'system' GROUP BY 1, 2),
c AS (SELECT conv_id, run, 1 AS ord, 'text' AS kind, section, string_agg(CASE WHEN role = 'user' THEN text END, chr(10) ORDER BY turn) AS body FROM t GROUP BY conv_id, run, section HAVING count(*) FILTER (role = 'user') > 0
      UNION ALL SELECT conv_id, run, 0, 'table', section, '| who | what |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || role || ' | ' || replace(replace(text, '|', '\|'), chr(10), ' ') || ' |' FROM t WHERE role = 'assistant'),
n AS (SELECT c.*, title, row_number() OVER (PARTITION BY conv_id ORDER BY run, ord) - 1 AS k FROM c LEFT JOIN h USING (conv_id, section))
SELECT conv_id, conv_id || '#' || lpad(CAST(k AS VARCHAR), 4, '0') AS chunk_id, kind, coalesce(title, '') AS section, sha256(CASE WHEN title IS NULL THEN '' ELSE '> ' || title || chr(10) END || body) AS text_sha FROM n""",
)
def turn_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents: a system turn is a heading, a user's a paragraph, an assistant's a table of one row."""
    role = F.col("role")
    t = table(spark, sf_dir, "conversations")
    blocks = t.select(
        "conv_id", F.col("turn").alias("seq"), F.when(role == "system", "h").when(role == "user", "p").otherwise("t").alias("kind"), F.lit(1).alias("level"), F.when(role == "system", F.concat(F.lit("T"), F.col("turn").cast("string"))).otherwise(F.col("text")).alias("text"),
        F.lit(None).cast("array<string>").alias("keys"), F.lit(None).cast("string").alias("value"), F.array(F.lit("who"), F.lit("what")).alias("headers"), F.when(role == "assistant", F.array(F.array("role", "text"))).alias("rows"),
    )
    return chunks.build_chunks(blocks, "conv_id").select("conv_id", "chunk_id", "kind", F.array_join("section_path", " > ").alias("section"), F.sha2("text", 256).alias("text_sha"))

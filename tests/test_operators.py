import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.functions import scalars as S
from docloom.operators import checks, chunks, joins, policy, retrieval, statements, windows
from docloom.plans.catalog import QUERIES


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text,kind",
    [("(단위 : 천원)", "unit"), ("(단위: 백만원, %)", "unit"), ("※ 상기 금액은 …", "footnote"), ("＊ 주석", "footnote"), ("그냥 문단이다", None), ("금액에 단위 표시 없음", None)],
)
def test_captions(spark, text, kind):
    assert value(spark, S.caption_kind(F.lit(text))) == kind


@pytest.mark.parametrize(
    "kind,before,after,want",
    [("unit", 0, 1, "next"), ("unit", 1, 0, "prev"), ("unit", 1, 1, "next"), ("unit", 0, 0, None), ("footnote", 1, 0, "prev"), ("footnote", 0, 1, "next"), ("footnote", 1, 1, "prev"), ("footnote", 0, 0, None)],
)
def test_attach(spark, kind, before, after, want):
    assert value(spark, windows.attach_direction(F.lit(kind), F.lit(bool(before)), F.lit(bool(after)))) == want


def test_scalars(spark):
    v = lambda c: value(spark, c)
    assert v(S.number(F.lit("2,227,819,930"))) == 2227819930 and v(S.number(F.lit("(1,234)"))) == -1234
    assert v(S.number(F.lit("△5"))) is None and v(S.number(F.lit(" "))) is None
    assert v(S.normal_label(F.lit("Ⅵ.기말현금및현금성자산"))) == "기말현금및현금성자산" and v(S.normal_label(F.lit("재고자산(주7)"))) == "재고자산"
    assert v(S.caption_unit(F.lit("(단위 : 천원)"))) == "천원"
    assert v(S.period_label(F.lit("제 17 기 1분기말 2023.03.31 현재"))) == "제 17 기 1분기말"
    assert v(S.period_of(F.lit("제 17 기 1분기말 2023.03.31 현재"))).asDict() == {"kind": "instant", "begin": "2023-03-31", "end": None}
    assert v(S.statement_code(F.lit("{XBRL}BS_S"))).asDict() == {"statement": "BS", "basis": "separate", "variant": None, "basis_source": "suffix"}
    assert v(S.statement_code(F.lit("{XBRL}IS_C3"))).asDict() == {"statement": "IS", "basis": "consolidated", "variant": 3, "basis_source": "suffix"}
    assert v(S.statement_code(F.lit("{XBRL}BS"))).basis == "consolidated" and v(S.statement_code(F.lit("{XBRL}NT_x"))) is None
    assert v(S.clean(F.lit("a 　  b\n\n​ c  "))) == "a b\nc"
    assert v(S.strip_legal_form(F.lit("(주) 가나 Co., Ltd."))) == "가나" and v(S.safe_filename(F.lit(' a/b:"c". '))) == "a_b__c_"
    assert v(S.decode_entities(F.lit("A&amp;lt; &lt;b"))) == "A&lt; <b"
    assert v(S.bare_ampersands(F.lit("삼성E&A &amp; &#12; &x"))) == 2
    assert v(S.unit_value_dates(F.lit("20230101-20230331"))) == "2023-01-01 ~ 2023-03-31" and v(S.iso_digits(F.lit("20230101"))) == "2023-01-01"
    assert v(S.kv_line(F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("string"))) == "a > b: (해당없음)"
    assert v(S.human_size(F.lit(2.5e9))) == "2.50 GB" and v(S.receipt_year(F.lit("20240321000001"))) == 2024


def test_section_path_is_the_fold(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for part in range(60):
        stack = []
        for seq in range(rng.randrange(1, 25)):
            level = rng.choice([None, 1, 2, 3, 4, 9])
            if level:
                stack = [*stack[: min(6, level) - 1], f"t{seq}"]
            rows.append((part, seq, level, f"t{seq}"))
            want[part, seq] = list(stack)
    df = spark.createDataFrame(rows, "part int, seq int, level int, title string")
    got = windows.section_path(df, ["part"], "seq", F.col("level"), F.col("title")).collect()
    assert {(r.part, r.seq): r.path for r in got} == want


def test_split_and_intervals(spark):
    n = lambda k: [len(p.rows) for p in value(spark, windows.split_rows(F.array(*[F.lit(i) for i in range(k)]) if k else F.array().cast("array<int>")))]
    assert n(95) == [40, 40, 15] and n(0) == [0] and n(40) == [40]
    df = spark.createDataFrame([(1,), (2,), (3,), (7,), (7,)], "x int")
    assert sorted(map(tuple, windows.intervals(df, "x").collect())) == [(1, 3), (7, 7)]
    assert sorted(r[0] for r in windows.expand(windows.intervals(df, "x")).collect()) == [1, 2, 3, 7]


def test_retrieval(spark):
    df = spark.createDataFrame([(1, "a", 0.9), (2, "a", 0.8), (3, "a", 0.7), (4, "b", 0.7), (5, "c", 0.1)], "row int, doc string, score double")
    assert [(r.rank, r.row) for r in retrieval.capped_top_k(df, 3, 2, "doc").collect()] == [(1, 1), (2, 2), (3, 4)]
    assert retrieval.entity_quota(6, 4) == 2
    q = spark.createDataFrame([("삼성전자와 SK하이닉스의 매출액 비교", "삼성전자", ["SK하이닉스"])], "q string, k string, o array<string>")
    assert q.select(retrieval.subquery(F.col("q"), F.col("k"), F.col("o"))).first()[0] == "삼성전자 매출액 비교"
    q = spark.createDataFrame([("삼성전자와 SK하이닉스의 배당 비교", "삼성전자", ["SK하이닉스"], "삼성전자 배당 비교"), ("A도, B은 A와 C", "B", ["A", "C"], "B은 A와"), ("A", "B", ["A"], "A"), ("A.x와 B", "B", ["A.x"], "B")], "q string, k string, o array<string>, w string")
    assert all(r.s == r.w for r in q.select("w", retrieval.subquery(F.col("q"), F.col("k"), F.col("o")).alias("s")).collect())
    hits = spark.createDataFrame([(1, 1, False), (1, 2, True), (1, 3, False), (2, 1, None)], "q int, rank int, ok boolean")
    got = {r.q: (r.hit_1, r.hit_k, r.mrr) for r in retrieval.metrics(hits, ["q"], 3).collect()}
    assert got == {1: (0.0, 1.0, 0.5), 2: (None, None, None)}
    m = retrieval.means(spark.createDataFrame([(1.0,), (None,), (0.0,)], "m double"), ["m"]).first()
    assert (m.m, m.n_m) == (0.5, 2)
    names = spark.createDataFrame([("SK",), ("SK Hynix",), ("Hynix Corp",)], "name string")
    got = retrieval.detect_entities(spark.createDataFrame([(1, "of SK Hynix Corp and SK")], "id int, t string"), names, "id", "t", "name").collect()
    assert sorted((r["at"], r.entity) for r in got) == [(7, "Hynix Corp"), (4, "SK")][::-1]


def test_superseded(spark):
    rows = [(1, "p", "x", "20240321", None), (2, "p", "x", "20240328", None), (3, "p", "x", "20240418", None), (4, "e", "x", "20240101", None), (5, "p", "x", "20250101", False), (6, "p", "x", "20200101", True)]
    df = spark.createDataFrame(rows, "id int, grp string, title string, receipt string, flag boolean")
    got = {r.id: r.is_superseded for r in retrieval.superseded(df, ["grp", "title"], "receipt", F.col("grp") == "p", "flag").collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False, 6: True}


def test_joins(spark):
    labels = spark.createDataFrame([(1, "제 17 기 1분기 3개월"), (2, "none")], "id int, label string")
    known = spark.createDataFrame([("제 17 기",), ("제 17 기 1분기",)], "prefix string")
    got = {r.id: (r.prefix, r.qualifier) for r in joins.longest_prefix(labels, "label", known, "prefix", ["id"], (6, 10)).collect()}
    assert got == {1: ("제 17 기 1분기", "3개월"), 2: (None, None)}
    h = lambda rows: spark.createDataFrame(rows, "k int, v string")
    got = {r.k: r.status for r in joins.regression(h([(1, "a"), (2, "b"), (3, "c")]), h([(2, "b"), (3, "x"), (4, "d")]), "k", "v").collect()}
    assert got == {1: "MISSING", 2: "PASS", 3: "FAIL", 4: "NEW"}


def test_identities(spark):
    rows = [("g", "BS", 0, 0, "자산총계", 10.0), ("g", "BS", 1, 0, "유동자산", 4.0), ("g", "BS", 2, 0, "비유동자산", 5.0), ("g", "BS", 3, 0, "매각예정비유동자산", 1.0), ("g", "BS", 4, 0, "부채총계", 3.0),
            ("c", "CF", 0, 0, "영업활동현금흐름", 5.0), ("c", "CF", 1, 0, "투자활동현금흐름", -2.0), ("c", "CF", 2, 0, "재무활동현금흐름", -1.0), ("c", "CF", 3, 0, "현금및현금성자산의환율변동효과", 1.0), ("c", "CF", 4, 0, "현금및현금성자산의순증감", 3.0)]
    df = spark.createDataFrame(rows, "group string, statement string, row int, column int, label string, value double")
    got = {r.name: r.status for r in statements.identities(df, statements.rule_terms(spark), 0.5).collect()}
    assert got == {"assets": "pass", "net change with exchange": "pass", "net change without exchange": "alternative"}
    assert value(spark, statements.column_total(F.array(F.lit(1.0), F.lit(None).cast("double"), F.lit(1.0))))
    assert value(spark, statements.column_total(F.array(F.lit(None).cast("double"), F.lit(None).cast("double")))) is None


def test_policy(spark):
    df = spark.createDataFrame([(1, "E&A <b> <별표> &amp; 1<2"), (2, None)], "id int, text string")
    got = {r.id: [(a["rule"], a["count"]) for a in r.actions] if r.actions else [] for r in policy.apply_stage(df, "text", policy.RULES, "sanitize").collect()}
    assert got == {1: [("E1_bare_ampersand", 1), ("E2_bare_lt", 2)], 2: []}
    escaping = (policy.Rule("X", "s", "&(?!amp;)", "escape", to="&amp;"),)
    r = policy.apply_stage(df, "text", escaping, "s").filter("id = 1").first()
    assert r.text.startswith("E&amp;A")
    with pytest.raises(ValueError):
        policy.apply_stage(df, "text", (policy.Rule("X", "s", "x", "unheard"),), "s")


def test_checks(spark):
    lost = lambda a, b: value(spark, checks.token_loss(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))))
    assert lost(["abcdef", "abc", "zzzz"], ["abc", "def", "x-zzzz"]) == [] and lost(["lost"], ["kept"]) == ["lost"]
    df = spark.createDataFrame([("a", "x"), ("a", " "), ("b", None)], "k string, v string")
    r = checks.contract(df, ["v"], "k").first()
    assert (r.n, r.blank_v, r.repeated_keys) == (3, 2, 1)
    with pytest.raises(ValueError):
        checks.require(df, ["v"], "k")


def test_chunks(spark):
    b = [
        ("d", 0, "h", 2, "a", None, None, None, None), ("d", 1, "p", None, "(단위 : 천원)", None, None, None, None), ("d", 2, "p", None, "text", None, None, None, None), ("d", 3, "kv", None, None, ["k"], None, None, None),
        ("d", 4, "t", None, None, None, None, ["x", "y"], [["r", "1"]] * 95), ("d", 5, "h", 3, "b", None, None, None, None), ("d", 6, "p", None, "※ note", None, None, None, None), ("d", 7, "p", None, "end", None, None, None, None),
    ]
    df = spark.createDataFrame(b, "part string, seq int, kind string, level int, text string, keys array<string>, value string, headers array<string>, rows array<array<string>>")
    got = chunks.build_chunks(df, "part").orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.kind, r.section_path, r.unit, r.n_rows, r.footnotes) for r in got] == [
        ("d#0000", "text", ["a"], "천원", None, None), ("d#0001", "table", ["a"], "천원", 40, None), ("d#0002", "table", ["a"], "천원", 40, None), ("d#0003", "table", ["a"], "천원", 15, ["※ note"]), ("d#0004", "text", ["a", "b"], None, None, None),
    ]
    assert got[0].text == "> a\n(단위: 천원)\ntext\n- k: (해당없음)" and got[1].text.startswith("> a\n(단위: 천원)\n(표 1–40행 / 전체 95행)\n| x | y |\n| --- | --- |\n| r | 1 |")


def test_containment_is_the_plain_search(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab한") for _ in range(n))
    values = [(p, word(rng.randrange(1, 12))) for p in "xy" for _ in range(60)]
    facts = [(i, p, word(rng.randrange(0, 6))) for i, p in enumerate("xyz" * 60)] + [(999, "x", None)]
    got = joins.containment(spark.createDataFrame(facts, "i int, p string, v string"), spark.createDataFrame(values, "p string, v string"), ["p"], "v")
    plain = lambda p, v: "missing" if v is None else "exact" if (p, v) in values else "inside" if any(q == p and v in w for q, w in values) else "missing"
    assert {r.i: r.how for r in got.collect()} == {i: plain(p, v) for i, p, v in facts}


def rows_made(df):
    """The greatest number of rows that a node of the executed plan put out."""
    df.collect()
    greatest, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        metric = node.metrics().get("numOutputRows")
        greatest = max(greatest, metric.get().value() if metric.isDefined() else 0)
        stack += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") else [node.children().apply(i) for i in range(node.children().size())]
    return greatest


def test_containment_makes_no_pairs_of_like_values(spark):
    names = [f"Customer#{i * 37:09d}" for i in range(1500)]
    facts = [(i, "x", w[: 9 + i % 10]) for i, w in enumerate(names)] + [(-1, "x", "mer#00003"), (-2, "x", "mer#00009"), (-3, "y", "Customer")]
    got = joins.containment(spark.createDataFrame(facts, "i int, p string, v string"), spark.createDataFrame([("x", w) for w in names], "p string, v string"), ["p"], "v")
    assert rows_made(got) < 25 * len(names)
    assert {r.i: r.how for r in got.collect()} == {i: "exact" if i >= 0 and v in names else "inside" if p == "x" and any(v in w for w in names) else "missing" for i, p, v in facts}


def test_whole_intervals_and_quantiles(spark):
    from docloom.operators import quantiles

    rng = random.Random(8)
    numbers = sorted({n for a in (0, 60, 63, 128, 500, -70) for n in range(a, a + rng.randrange(1, 90))})
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    assert sorted(map(tuple, windows.whole_intervals(df, "n", 64).collect())) == sorted(map(tuple, windows.intervals(df, "n").collect()))
    rows = [(g, float(rng.choice([1, 2, 2, 2, rng.randrange(1000)]))) for g in "abc" for _ in range(rng.choice([1, 2, 700]))] + [("a", None)]
    got = quantiles.percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"q1": 0.25, "q9": 0.9, "top": 1.0}).collect()
    import numpy as np

    for r in got:
        own = [v for g, v in rows if g == r.g and v is not None]
        assert np.allclose([r.q1, r.q9, r.top], np.quantile(own, [0.25, 0.9, 1.0]))


def test_small_predicates(spark):
    from docloom.operators import documents, tables

    df = spark.createDataFrame([("2024년 3 월",), ("제 25 기 1분기",), ("과목",), ("1,234",), ("2024.01.02",)], "t string")
    assert {r.t: r.v for r in df.select("t", tables.header_cell(F.col("t")).alias("v")).collect()} == {"2024년 3 월": True, "제 25 기 1분기": True, "과목": True, "1,234": False, "2024.01.02": False}
    marks = lambda *x: F.array(*[F.lit(v) for v in x])
    assert value(spark, tables.shaded_header(marks("TD", "TD"), marks("BC0x", "bc0"), F.lit(3))) and not value(spark, tables.shaded_header(marks("TD"), marks("BC0"), F.lit(1)))
    captions = F.array(F.lit("제 17 기 1분기 2023.01.01 부터 2023.03.31 까지"), F.lit("제 17 기 2023.03.31 현재"), F.lit("(단위 : 원)"))
    got = value(spark, tables.column_periods(F.array(F.lit("과목"), F.lit("제17기 1분기 3개월"), F.lit("제 17 기말")), tables.caption_periods(captions)))
    assert [(r.period.begin if r.period else None, r.qualifier) for r in got] == [(None, None), ("2023-01-01", "3개월"), ("2023-03-31", "말")]
    m = spark.createDataFrame([("d", "g", "1", "co", "r", "20240101", "rep", False, "pdf", "x/y.pdf"), ("e", "g", "2", "co2", "r2", "20240102", "rep2", True, "xml", "z")], "doc_id string, doc_group string, corp_code string, corp_name string, rcept_no string, rcept_dt string, report_nm string, is_correction boolean, file_format string, file_path string")
    env = {r.doc_id: r for r in documents.envelope(m, spark.createDataFrame([("e", "e_2", "B"), ("e", "e_1", "A")], "doc_id string, part_key string, doc string")).collect()}
    assert [p.part_key for p in env["e"].parts] == ["e_1", "e_2"] and env["d"].n_parts == 0 and env["e"].schema == documents.SCHEMA
    rows = documents.envelope(m, spark.createDataFrame([("e", "e_1", "A")], "doc_id string, part_key string, doc string"))
    assert {r.doc_id: r.v for r in rows.select("doc_id", documents.part_doc(F.col("parts"), F.lit("e_1")).alias("v")).collect()} == {"d": None, "e": "A"}
    assert [(r.doc_id, r.kind, r.text) for r in documents.placeholders(m).orderBy("seq").collect()] == [("d", "h", "co · rep"), ("d", "p", "pdf_only_no_text_extraction: x/y.pdf")]
    w = documents.worker_totals(spark.createDataFrame([(3.0, 10.0, 1), (5.0, None, 2)], "seconds double, chunks_per_sec double, n_skipped int")).first()
    assert (w.n_workers, w.wall_seconds, w.chunks_per_sec, w.n_skipped) == (2, 5.0, 10.0, 3)


def plain_hybrid(rows, queries, settings, k, cap):
    x = rows.crossJoin(queries.select(F.explode("qs").alias("x"))).withColumn("w", F.explode(F.array(*[F.struct(F.lit(a).alias("w_dense"), F.lit(b).alias("w_sparse")) for a, b in settings])))
    shared = F.coalesce(F.size(F.array_intersect(F.array_distinct(F.split("text", " ")), "x.toks")), F.lit(0))
    x = x.select(F.col("x.qid").alias("qid"), "row", "group", "w.*", F.round(S.dot(F.col("v"), F.col("x.q")), 6).alias("dense"), F.greatest(shared, F.lit(0)).cast("long").alias("sparse"))
    x = x.withColumn("score", F.round(F.col("w_dense") * F.col("dense") + F.col("w_sparse") * F.col("sparse"), 6))
    by = ["qid", "w_dense", "w_sparse"]
    if k is None:
        return retrieval.top_k_each(x, [*by, "group"], cap)
    return retrieval.top_k_each(x, by, k) if cap is None else retrieval.capped_top_k(x, k, cap, "group", by=by)


@pytest.mark.parametrize("k,cap", [(5, None), (6, 2), (4, 9), (None, 2), (50, 1)])
@pytest.mark.parametrize("odd", [False, True])
def test_hybrid_is_the_plain_search(spark, k, cap, odd):
    """Copies, ties, words twice and none, null texts and groups; odd: null, short and empty vectors, null and NaN elements."""
    rng = random.Random(f"{k}{cap}{odd}")
    vector = lambda: [round(rng.uniform(-1, 1), rng.choice((1, 7))) for _ in range(5)]
    strange = (None, [], [0.5, 0.25], [None, 1.0, 1.0, 1.0, 1.0], [float("nan"), 1.0, 1.0, 1.0, 1.0])
    copies = [vector() for _ in range(3)]
    any_vector = lambda: rng.choice(strange) if odd and rng.random() < 0.2 else rng.choice(copies) if rng.random() < 0.5 else vector()
    words = lambda: " ".join(rng.choice(["a", "b", "ab", "é", "", "c", "a"]) for _ in range(rng.randrange(8)))
    rows = [(i * 7, rng.choice(["x", "y", "z", None]), any_vector(), None if rng.random() < 0.1 else words()) for i in range(90)]
    queries = [(i // 4, [(i, any_vector(), None if i % 4 == 0 or i > 7 else list(dict.fromkeys(words().split(" "))))]) for i in range(11)]
    rows = spark.createDataFrame(rows, "row long, `group` string, v array<float>, text string").repartition(3)
    queries = spark.createDataFrame(queries, "block long, qs array<struct<qid: long, q: array<float>, toks: array<string>>>").groupBy("block").agg(F.flatten(F.collect_list("qs")).alias("qs"))
    settings = [(1.0, 0.0), (1.0, 0.05), (0.0, 1.0), (-0.5, 0.3)]
    got = retrieval.hybrid_top_k(retrieval.text_blocks(rows, "row", "group", "text", "v", size=13), queries, settings, k, cap)
    want = plain_hybrid(rows, queries, settings, k, cap).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_round_half_up_is_sparks(spark):
    rng = random.Random(1)
    xs = [rng.randrange(-(10**7), 10**7) / 10**7 for _ in range(400)] + [1.0000005, -2.5e-6, 0.5e-6, -0.5e-6, -1e-9, 123456789.0123455, 1e15, -3e18, 1e25]
    want = [r.v for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", F.round("x", 6).alias("v")).orderBy("i").collect()]
    assert retrieval.round_half_up(np.array(xs), 6).tolist() == want


@pytest.mark.parametrize("name", ["hybrid_topk", "multi_entity_interleave", "weight_sweep"])
def test_search_makes_no_row_for_each_pair(spark, sf_dir, name):
    assert "Generate" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()

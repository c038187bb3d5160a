import pytest
from pyspark.sql import functions as F

from docloom.__main__ import main, render
from docloom.engine import Engine, encode, hashing_encoder, re_embedding_cosine
from docloom.operators import documents, forms, tables
from docloom.sources import files, markup


@pytest.fixture(scope="module")
def chunks(spark):
    rows = []
    for c, name in enumerate(["삼성전자", "SK하이닉스", "Alpha Corp"]):
        for i in range(12):
            text = f"{name} section {i} " + ("revenue and sales growth" if i == 3 else f"other matter number {i}")
            rows.append((f"{c}-{i:02d}", text, f"doc{c}{i // 4}", f"00000{c}", "periodic", f"2024010{i // 6 + 1}000001", name, f"report {i // 6}", ["a", f"s{i}"], text, None))
    rows.append(("old", "삼성전자 revenue and sales growth", "docold", "000000", "periodic", "20230101000001", "삼성전자", "report 0", ["a", "s3"], "old text", None))
    return spark.createDataFrame(rows, files.CHUNK)


def test_search(spark, chunks, tmp_path):
    e = Engine.build(chunks, path=str(tmp_path / "i"))
    got = e.search("revenue sales growth", 3, company="삼성전자").collect()
    assert got[0].chunk_id == "0-03" and {r.company for r in got} == {"삼성전자"} and "old" not in {r.chunk_id for r in got}
    assert e.entities("삼성전자와 SK하이닉스의 revenue 비교") == ["삼성전자", "SK하이닉스"]
    assert e.entities("compare SK하이닉스 and 삼성전자") == ["SK하이닉스", "삼성전자"]
    multi = e.search_multi("삼성전자와 SK하이닉스의 revenue sales growth 비교", 4).orderBy("position").collect()
    assert [r.company for r in multi] == ["삼성전자", "SK하이닉스"] * 2
    multi = e.search_multi("compare SK하이닉스 and 삼성전자 revenue sales growth", 4).orderBy("position").collect()
    assert [r.company for r in multi] == ["SK하이닉스", "삼성전자"] * 2 and {"1-03", "0-03"} <= {r.chunk_id for r in multi}
    assert max(r["count"] for r in e.search("other matter", 6, cap=1).groupBy("doc_id").count().collect()) == 1
    with pytest.raises(LookupError):
        e.search("x", company="nobody")
    q = spark.createDataFrame([("q1", "revenue sales growth", "삼성전자", None, ["s3"], None), ("q2", "other matter", None, None, None, None)], files.QUESTION)
    each, mean = e.evaluate(q, 3)
    assert {r.id: (r.hit_1, r.strict_1, r.company_k) for r in each.collect()} == {"q1": (1.0, 1.0, 1.0), "q2": (None, None, None)} and mean.first().n_mrr == 1
    q = spark.createDataFrame([("q3", "삼성전자와 SK하이닉스의 revenue sales growth", None, ["삼성 전자", "SK하이닉스", "nobody"], ["s3"], None), ("q4", "other matter", "Alpha Corp", None, ["nowhere"], None)], files.QUESTION)
    each, mean = e.evaluate(q, 4)
    assert {r.id: (r.hit_1, r.strict_1, r.entity_coverage) for r in each.collect()} == {"q3": (1.0, None, 0.6667), "q4": (0.0, 0.0, None)} and mean.first().n_strict_1 == 1
    assert e.sweep("revenue", [(1, 0), (0, 1), (0, 0)], 2).count() == 4 and e.sweep(q, [(1, 0), (0, 1)], 2).count() == 8
    assert re_embedding_cosine(e.index, e.encoder, fraction=1.0).first().least > 0.999
    main(["ask", str(tmp_path / "i"), "revenue", "-k", "1"])
    assert render(got, 5).startswith("1. [")


def test_encoder_halves(spark):
    plain = hashing_encoder(8)

    def tight(texts):
        if len(texts) > 1 or "big" in texts[0]:
            raise MemoryError
        return plain(texts)

    got = encode(spark.createDataFrame([("a",), ("big",), ("b",)], "t string"), "t", tight).collect()
    assert [r.embedding is None for r in got] == [False, True, False]


def test_forms():
    root = markup.tree('<SECTION-1><TITLE>One</TITLE><TABLE><TR><TD>Name</TD><TE ACODE="N1">Kim</TE><TD>Born</TD><TU AUNIT="D" AUNITVALUE="20230101">2023</TU></TR><TR><TD>Sum</TD><TE>-</TE></TR></TABLE></SECTION-1>')
    f = list(forms.facts(root))
    assert [(x["code"], x["labels"], x["norm"], x["table_path"]) for x in f] == [("N1", ["Name"], None, ["One"]), ("D", ["Name", "Born"], "20230101", ["One"])]
    assert [(x["keys"], x["value"]) for x in forms.form_values(root)] == [(["Name"], "Kim"), (["Born"], "2023")]
    assert [x["value"] for x in forms.form_values(root, drop_empty=False)] == ["Kim", "2023", None]
    assert forms.pair([("a", True), ("b", True), ("1", False), ("2", False), ("won", True)]) == [(["a", "b"], "1"), (["a", "b [2]"], "2 won")]
    assert forms.pair([("v", False)], ["above"]) == [(["above"], "v")] and forms.pair([("v", False)]) == []
    assert forms.colon_pair(["보고 자 :", "국민연금공단"]) == ("보고자", "국민연금공단") and forms.colon_pair(["x", "y"]) is None


def test_form_frames(spark):
    src = '<TABLE><TR><TD>a</TD><TE ACODE="X">1</TE></TR><TR><TD>a</TD><TE>2</TE></TR></TABLE>'
    df = spark.createDataFrame([(1, src), (2, None)], "id long, s string")
    assert forms.extract_facts(df, "id", "s").count() == 1
    assert sorted((r.field, r.value) for r in forms.field_view(forms.extract_values(df, "id", "s"), "id").collect()) == [("a", "1"), ("a#2", "2")]


def test_tables(spark):
    v = lambda c, rows: spark.createDataFrame([(rows,)], "rows array<array<string>>").select(c.alias("v")).first()["v"]
    rows = [["item", "2022", "2022"], ["", "first", "second"], ["x", "1,000", "2"], ["", "", ""]]
    r = F.col("rows")
    assert v(tables.verdict(r), rows) == "real_table" and v(tables.verdict(r), [["a"]]) == "not_a_table" and v(tables.verdict(r), []) == "empty"
    assert v(tables.header_rows(r), [["a", "b"], ["x", "1"]]) == 1 and v(tables.body(r, F.lit(2)), rows) == [["x", "1,000", "2"]]
    assert v(tables.merged_header(r, F.lit(2)), rows) == ["item", "2022 first", "2022 second"]
    assert v(tables.live_columns(r), [["a", "a", "b"], ["c", "c", "d"]]) == [["a", "b"], ["c", "d"]]
    t = [("d", 0, "(단위 : 원)", [["(단위 : 원)"]]), ("d", 1, None, rows), ("d", 2, "※ note", [["※ note"]])]
    j = tables.judge_captions(spark.createDataFrame(t, "d string, o int, text string, rows array<array<string>>"), ["d"], "o")
    assert [(x.caption, x.attach, x.unit) for x in j.orderBy("o").collect()] == [("unit", "next", "원"), (None, None, None), ("footnote", "prev", None)]
    assert tables.invariants(j, ["d", "o"]).count() == 0 and tables.caption_census(j, []).count() == 2
    g = [("d", 0, "{XBRL}BS_S", [["재무상태표"], ["(단위 : 천원)"], ["제 17 기 2023.03.31 현재"]]), ("d", 1, "{XBRL}BS_S", [["과목", "제 17 기"], ["자산총계", "10"]])]
    s = tables.statement_groups(spark.createDataFrame(g, "d string, o int, code string, rows array<array<string>>"), ["d"], "o", "code").first()
    assert (s.statement, s.basis, s.unit, s.header, s.rows, len(s.periods)) == ("BS", "separate", "천원", ["과목", "제 17 기"], [["자산총계", "10"]], 1)
    p = lambda rows: tables.pdf_blocks(spark.createDataFrame([(rows,)], "rows array<array<string>>")).first().kind
    assert p([["a"]]) == "p" and p([["a", "1"]]) == "kv" and p([["a", "b", "1"]]) == "kv" and p([["a", "1", "2"]]) == "t"


def test_documents(spark):
    df = spark.createDataFrame([(1, '<h1>T</h1><h2>A</h2><p>제 1 기 2023.1.2 현재</p><table><tr><th>x<th>y<tr><td>1<td>2|3</table><h2>A</h2>')], "doc_id long, s string")
    b = markup.parse_blocks(df, "doc_id", "s")
    m = documents.markdown(b, "doc_id").first().markdown
    assert m == "# T\n\n## A\n\n제 1 기 2023.1.2 현재\n\n| x | y |\n|---|---|\n| 1 | 2\\|3 |\n\n## A\n"
    i = documents.document_index(spark.createDataFrame([(1,), (2,)], "doc_id long"), b).orderBy("doc_id").collect()
    assert [(r.status, r.toc, r.n_tables) for r in i] == [("ok", ["A"], 1), ("no_source", None, None)]
    p = documents.period_dictionary(b.filter("kind = 'p'"), "doc_id", F.col("text"))
    assert (p.first().label, p.first().period.begin) == ("제 1 기", "2023-01-02")
    assert documents.ungrounded_dates(p, df.select("doc_id", F.lit("nothing").alias("t")), "doc_id", "t").first().date == "2023-01-02"
    assert tables.sections(b, "doc_id").count() == 1 and documents.diagnostics(df, b, "doc_id", "s").first().n_t == 1


def test_small_document_functions(spark):
    v = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    assert v(documents.with_iso(F.lit("2023"), F.lit("2023-01-01"))) == "2023 (2023-01-01)" and v(documents.with_iso(F.lit("x 2023-01-01"), F.lit("2023-01-01"))) == "x 2023-01-01"
    assert v(documents.markdown_name(F.lit("a/b"), F.lit("d1"), F.lit(None).cast("string"))) == "a_b_d1.md"
    assert v(documents.old_name(F.lit("주식회사 가나"), F.lit("가나"))) is None and v(documents.old_name(F.lit("옛이름"), F.lit("가나"))) == "옛이름"
    assert v(documents.company_in_markup(F.lit("<TITLE>가나 / x</TITLE>"))) == "가나" and v(documents.company_in_markup(F.lit("<COMPANY-NAME a='1'><b>다라</b></COMPANY-NAME>"))) == "다라"
    assert v(documents.document_type(F.array(F.lit("표지"), F.lit("사업보고서")))) == "사업보고서" and v(documents.heading_like(F.lit("【x】"), F.lit(True), F.lit(False)))
    assert [tuple(x) for x in v(documents.cover_pairs(F.lit("회사: 가 대표: 나"), r"회사: (\S+) 대표: (\S+)", ["c", "d"]))] == [("c", "가"), ("d", "나")]
    b = markup.parse_blocks(spark.createDataFrame([(1, "<table><tr><td>a (2023-01-01)<td>2<td>3</table>")], "id int, s string"), "id", "s")
    assert sorted(r.value for r in documents.value_set(b, "id").collect()) == ["2", "3", "a", "a (2023-01-01)"]
    assert b.select(documents.block_text().alias("t")).first().t == "a (2023-01-01) 2 3"
    a = documents.alias_sets(spark.createDataFrame([("k", "x", "x"), ("k", "y", "x"), ("k", " ", "x")], "k string, n string, c string"), "k", "n", "c")
    assert a.first().aliases == ["y"]
    w = spark.createDataFrame([("g", "r1", 1.0, 5.0, "fail"), ("g", "r2", 1.0, 1.0, "pass")], "g string, name string, total double, sum double, status string")
    assert tuple(documents.worst_checks(w, ["g"]).first()) == ("g", 2, 1, "r1", 4.0)


def test_more_sources(spark, tmp_path):
    import json

    (tmp_path / "q.jsonl").write_text("\n".join(json.dumps({"id": i, "question": "x"}) for i in ("b", "a", "c")))
    assert [r.id for r in files.read_questions(spark, str(tmp_path / "q.jsonl"), ["a", "c"], 1).collect()] == ["a"]
    d = spark.createDataFrame([("d", [("p1",), ("p2",)])], "doc_id string, parts array<struct<part_key:string>>")
    files.write_documents(d, str(tmp_path / "docs"))
    assert [(r.part_no, r.part.part_key) for r in files.read_documents(spark, str(tmp_path / "docs"), "doc_id string, parts array<struct<part_key:string>>").orderBy("part_no").collect()] == [(0, "p1"), (1, "p2")]
    i = spark.createDataFrame([("r", "b", 1), ("r", "a", 2)], "rcept_no string, doc_id string, x int")
    assert files.first_by_receipt(i).first().doc_id == "a" and files.without_skipped(i, spark.createDataFrame([("a",)], "doc_id string")).count() == 1
    (tmp_path / "md" / "corp").mkdir(parents=True)
    (tmp_path / "md" / "corp" / "1.md").write_text("# x\n별칭: a, b\n")
    (tmp_path / "md" / "corp" / "2.md").write_text("별칭: c\n")
    assert files.sibling_aliases(spark, str(tmp_path / "md")).first().names == ["a", "b"]
    key = spark.createDataFrame([("d", "20240101000001", "/x/corp/20240101000001_00760.xml"), ("d", "20240101000001", "/x/20240101000001.xml")], "d string, r string, p string")
    assert [r.k for r in key.select(files.part_key(F.col("d"), F.col("r"), F.col("p")).alias("k")).collect()] == ["d_00760", "d"]


def test_repl():
    from docloom.__main__ import repl

    lines, said, asked = iter(["/company A", "/k 2", "what", "/bad", "/reset", "why", "/q", "never"]), [], []

    class Rows:
        def collect(self):
            return []

    def ask(q, k, company=None):
        asked.append((q, k, company))
        return Rows()

    repl(ask, lambda _: next(lines), said.append)
    assert asked == [("what", 2, "A"), ("why", 5, None)] and "unknown command /bad" in said

import pytest
from pyspark.sql import functions as F

from docloom import reports
from docloom.operators import policy, suite
from docloom.sources import config, markup


def test_suite(spark):
    s = spark.createDataFrame([("a", "한글 텍스트"), ("b", "ascii only")], "key string, text string")
    b = spark.createDataFrame([("a", "h", [["x"]]), ("a", "t", [["x", "y"], ["z"]])], "key string, kind string, rows array<array<string>>")
    out, code = suite.run(spark, ["encoding", "grid", "keys"], sources=s, blocks=b)
    assert [(r["check"], r["verdict"], r["failed"]) for r in out] == [("encoding", "fail", 1), ("grid", "fail", 1), ("keys", None, None)] and code == suite.FAILED
    empty = spark.createDataFrame([], b.schema)
    assert suite.run(spark, ["grid"], blocks=empty)[0][0]["verdict"] is None
    assert suite.run(spark, ["grid"], blocks=s)[1] == suite.BROKEN
    esc = policy.apply_stage(s.withColumn("text", F.lit("a&b&c")), "text", (policy.Rule("X", "s", "&(?!amp;)", "escape", to="&amp;"),), "s")
    ok = esc.select("key", "text", F.element_at("actions", 1)["count"].alias("n_escaped"))
    assert suite.run(spark, ["sanitize"], sources=s.withColumn("text", F.lit("a&b&c")), escaped=ok)[1] == suite.PASSED
    h = spark.createDataFrame([("k", "1")], "key string, sha string")
    assert suite.run(spark, ["regression"], baseline=h, current=h)[1] == suite.PASSED
    f = spark.createDataFrame([("k", "va"), ("k", "zz")], "key string, value string")
    assert suite.run(spark, ["grounding"], facts=f, values=spark.createDataFrame([("k", "value")], "key string, value string"))[0][0]["failed"] == 1


def test_strictness_and_sample(spark):
    df = spark.createDataFrame([(1, "<a>x</a>"), (2, "<a>x"), (3, "x"), (4, None)], "id int, s string")
    assert [r.xml_status for r in suite.strictness(df, "s").orderBy("id").collect()] == ["strict_ok", "recovered", "failed", None]
    assert [r.id for r in suite.systematic_sample(df.withColumn("g", F.lit(1)), ["g"], "id", 2).collect()] == [1, 3]


def test_config(spark, tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text('{"a": "file"}')
    assert config.resolve("a", "x", "DOCLOOM_A", str(tmp_path / "c.json")) == "file" and config.resolve("b", "x") == "x"
    monkeypatch.setenv("DOCLOOM_A", "env")
    assert config.resolve("a", "x", "DOCLOOM_A", str(tmp_path / "c.json")) == "env"
    assert config.nfc(spark.createDataFrame([("é",), ("a",), (None,)], "s string"), "s").collect()[0].s == "é"
    pytest.importorskip("yaml")
    (tmp_path / "p.yaml").write_text("policies:\n- {id: X, stage: s, detect: {type: regex, pattern: 'a+'}, handle: {type: count_only}}\n- {id: Y, stage: s, detect: {type: manual}, handle: {type: defer}, severity: warn}\n")
    assert config.load_policy(str(tmp_path / "p.yaml")) == (policy.Rule("X", "s", "a+"), policy.Rule("Y", "s", None, "defer", "warn"))


def test_reports(spark, tmp_path):
    text = "a\n<!-- BEGIN n -->\nold\n<!-- END n -->\nb"
    assert reports.inject(text, "n", "new\\1") == "a\n<!-- BEGIN n -->\nnew\\1\n<!-- END n -->\nb"
    with pytest.raises(ValueError):
        reports.inject(text, "m", "x")
    once = reports.insert_notices("1\n2\n3", [(2, "two"), (3, "three")])
    assert once == "<!-- notices -->\n1\ntwo\n2\nthree\n3" and reports.insert_notices(once, [(1, "x")]) == once
    reports.write_markdown(spark.createDataFrame([("d1", "# t\nx")], "n string, m string"), "n", "m", str(tmp_path / "md"))
    assert [r.value for r in spark.read.text(str(tmp_path / "md"), lineSep="\0").collect()] == ["# t\nx\n"]
    assert reports.markdown_table([{"a": 1.0, "b": None}]) == "| a | b |\n|---|---|\n| 1.000 |  |"
    tags = markup.tag_profile(markup.parse_nodes(spark.createDataFrame([(1, "<p>x<한글>")], "id int, s string"), "id", "s"), "id")
    assert reports.profile_summary(tags).first().tag == "p"
    m = spark.createDataFrame([("q", 1.0)], "id string, hit double")
    assert "| hit | 1.000 | 1 |" in reports.metrics_report(m, m.agg(F.avg("hit").alias("hit"), F.count("hit").alias("n_hit")))


def test_more_checks(spark):
    t = spark.createDataFrame([("a", [f"t{i}" for i in range(100)], [f"t{i}" for i in range(70)]), ("b", ["x"], [])], "key string, source array<string>, output array<string>")
    assert suite.run(spark, ["coverage"], tokens=t)[0][0]["failed"] == 1
    j = spark.createDataFrame([("unit", "next", False, True), ("unit", "prev", False, True), (None, None, False, False)], "caption string, attach string, before_real boolean, after_real boolean")
    assert [suite.run(spark, ["captions"], judged=j)[0][0][k] for k in ("n", "failed")] == [2, 1]
    p = spark.createDataFrame([("a", ("instant", "2023-01-02", None)), ("b", ("instant", "2023-01-03", None))], "key string, period struct<kind:string,begin:string,end:string>")
    bodies = spark.createDataFrame([("a", "on 2023.1.2"), ("b", "nothing")], "key string, text string")
    assert [suite.run(spark, ["periods"], period_dates=p, bodies=bodies)[0][0][k] for k in ("n", "failed")] == [2, 1]
    m = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "doc_id string, corp string")
    i = spark.createDataFrame([("a", "x"), ("b", "other"), ("c", "z"), ("c", "z")], "doc_id string, corp string")
    assert [suite.run(spark, ["index"], manifest=m, document_index=i, fields=["corp"])[0][0][k] for k in ("n", "failed")] == [3, 2]
    s = spark.createDataFrame([("pass",), ("fail",), ("alternative",)], "status string")
    assert suite.run(spark, ["sums"], identities=s)[0][0]["failed"] == 1 and len(suite.CHECKS) >= 14

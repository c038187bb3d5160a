import json
import random

import pytest
from pyspark.sql import functions as F

from docloom.sources import files, markup
from docloom.streaming import events as streams


@pytest.mark.parametrize(
    "spans,width",
    [([[(1, 1)] * 3] * 2, 3), ([[(23, 1), (1, 1)]] + [[(1, 1)]] * 22, 2), ([[(3, 1)] * 6, [(1, 1)] * 6, [(1, 1)] * 6], 12), ([[(2, 2), (1, 1)], [(1, 1)], [(1, 1)] * 3], 3), ([[(1, 5)], [(1, 1)] * 5], 5), ([], 0)],
)
def test_grid(spans, width):
    g = markup.grid(spans)
    assert all(len(r) == width for r in g) and len(g) == len(spans)


def test_blocks():
    b = lambda s: list(markup.blocks(markup.tree(s)))
    assert [(x["kind"], x["text"]) for x in b("<h1>T</h1><p>one<p>two &amp; E&A &unknown x<br>y<script>no</p></script>")] == [("h", "T"), ("p", "one"), ("p", "two & E&A &unknown x\ny")]
    t = b("<table><tr><th rowspan=2>a<th colspan=2>b<tr><th>c<th>d<tr><td>1<td>2<td>3</table>")[0]
    assert t["headers"] == ["a", "b > c", "b > d"] and t["rows"] == [["1", "2", "3"]]
    assert [(x["keys"], x["value"]) for x in b("<table><tr><th>k</th><td>v</td></tr><tr><th>n</th><td></td></tr></table>")] == [(["k"], "v"), (["n"], None)]
    assert len([x for x in b("<LIBRARY><LIBRARY><SECTION-2><TITLE>a</TITLE></SECTION-2></LIBRARY><SECTION-2><TITLE>b</TITLE></SECTION-2></LIBRARY>") if x["kind"] == "h"]) == 2


def test_parse_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x")], "id long, s string")
    assert [(r.id, r.text) for r in markup.parse_blocks(df, "id", "s").collect()] == [(3, "x")]
    n = markup.parse_nodes(df, "id", "s")
    assert [(r.tag, r.path, r.text) for r in n.collect()] == [("p", "/p", "x")]


def test_decode(spark):
    raw = [(1, bytearray("가나".encode())), (2, bytearray(b"\xef\xbb\xbfabc")), (3, bytearray("가나".encode("cp949"))), (4, bytearray(b"\xff\xff")), (5, None)]
    got = {r.id: (r.text, r.encoding, r.had_bom) for r in files.decode(spark.createDataFrame(raw, "id int, content binary")).collect()}
    assert got[1] == ("가나", "utf-8", False) and got[2] == ("abc", "utf-8", True) and got[3][:2] == ("가나", "cp949") and "�" in got[4][0] and got[5][0] is None


def test_manifest_and_jobs(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps(x) for x in [{"doc_id": " a ", "corp_name": "x", "file_path": "g/f1"}, {"doc_id": "a", "corp_name": "y", "file_path": "g/f1"}, {"doc_id": "b", "file_path": "g/none"}]))
    m = files.read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert sorted((r.doc_id, r.corp_name) for r in m.collect()) == [("a", "y"), ("b", None)]
    d = tmp_path / "raw" / "f1"
    d.mkdir(parents=True)
    (d / "2.xml").write_text("x")
    (d / "1.xml").write_text("y")
    j = {r.doc_id: (r.status, [f.rsplit("/", 1)[1] for f in r.files or []]) for r in files.jobs(m, files.list_files(spark, str(tmp_path / "raw"))).collect()}
    assert j == {"a": ("ok", ["1.xml", "2.xml"]), "b": ("no_source", [])}
    found = files.digests(spark, str(tmp_path / "raw"))
    want = found.withColumn("sha256", F.when(F.endswith("path", F.lit("1.xml")), F.lit("no")).otherwise(F.col("sha256")))
    assert sorted(r.status for r in files.verify_package(want, found).collect()) == ["mismatch", "ok"]


def test_index_tables(spark, tmp_path):
    rows = [(f"c{i:03d}", f"text {i}", f"d{i % 7}", "000001", "periodic", f"2024010100000{i % 10}", "co", "t", None, "c", None) for i in range(50)]
    chunks = spark.createDataFrame(rows, files.CHUNK)
    m = files.id_map(chunks).collect()
    assert sorted((r.row, r.chunk_id) for r in m) == [(i, f"c{i:03d}") for i in range(50)] and m[0].base_year == 2024
    files.write_index(chunks, str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i/embed_texts")).count() == 50
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_index(chunks, str(tmp_path / "i"))
    files.compact(chunks, spark.createDataFrame([("d1",)], "doc_id string"), str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k")).filter("doc_id = 'd1'").count() == 0


def test_streams(spark, sf_dir, tmp_path):
    (tmp_path / "in").mkdir()
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    batch.write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = streams.tumbling(stream, "1 hour", "event_type").writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    key = lambda df: sorted((r.start, r.event_type, r.n) for r in df.collect())
    assert key(spark.table("tumbled")) == key(streams.tumbling(batch, "1 hour", "event_type"))
    q = streams.keep_latest(stream.select("user_id", "event_id", "value"), str(tmp_path / "latest"), ["user_id"], "event_id", str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {r.user_id: r.event_id for r in spark.read.parquet(str(tmp_path / "latest/v0")).collect()}
    assert got == {r.user_id: r.m for r in batch.groupBy("user_id").agg(F.max("event_id").alias("m")).collect()}
    s = spark.createDataFrame([("a", 1.0, "h"), ("b", 2.0, "h"), ("c", 3.0, "h2")], "k string, modified double, config_hash string")
    d = spark.createDataFrame([("a", 1.0, "h"), ("c", 3.0, "h")], "k string, modified double, config_hash string")
    assert sorted(r.k for r in streams.to_rebuild(s, d, "k").collect()) == ["b", "c"]


@pytest.mark.parametrize("source,n", [("<font>a" * 5000, 1), ("<table><tr><td>a<td>b" * 1500, 1500), ("<p>x<b>" * 3000 + "</i>" * 3000, 3000), ("<section-1><title>t</title>" * 800, 800)])
def test_tags_that_nest_without_end(source, n):
    root = markup.tree(source)
    assert len(list(markup.blocks(root))) >= min(n, 1) and len(list(markup.nodes(root))) >= n and root.text()
    assert len(list(root.find("font", "td", "p", "title"))) >= n


def test_spans_are_bounded():
    root = markup.tree('<table><tr><td colspan="1000000">a</td></tr><tr><td rowspan="99999999">b</td><td colspan="x">c</td></tr></table>')
    t = markup.read_table(next(root.find("table")))
    assert len(t.texts) == 2 and len(t.texts[0]) == markup.GREATEST_SPAN and t.texts[1][:3] == ["b", "c", ""]


def test_deep_forms():
    from docloom.operators import forms

    root = markup.tree("<div>" * 2000 + '<title>One</title><table><tr><td>a</td><te acode="X">1</te></tr></table>')
    assert [(f["code"], f["table_path"]) for f in forms.facts(root)] == [("X", ["One"])]


def test_pickles_with_a_cut_tail(spark, tmp_path):
    import pickle

    whole = b"".join(pickle.dumps([(i, {10: 0.5, 20 + i: 1.0})]) for i in range(3))
    (tmp_path / "a.pkl").write_bytes(whole + pickle.dumps([(9, {1: 1.0})])[:-4])
    (tmp_path / "b.pkl").write_bytes(b"")
    (tmp_path / "c.pkl").write_bytes(whole + b"cos\nsystem\n(S'true'\ntR.")
    got = files.read_postings(spark, str(tmp_path)).collect()
    assert len(got) == 12 and {r.n_good for r in got} == {len(whole)} and {r.row for r in got} == {0, 1, 2}


def test_rows_of_the_id_map(spark):
    rows = [(f"c{i:03d}", f"text {i}", "d", "000001", "periodic", "20240101000001", "co", "t", None, "c", None) for i in range(20)]
    chunks = spark.createDataFrame(rows, files.CHUNK)
    ids = files.id_map(chunks)
    assert [(r.row, r.chunk_id) for r in files.chunks_of_rows(chunks, ids, spark.createDataFrame([(3,), (7,), (99,)], "row long")).orderBy("row").collect()] == [(3, "c003"), (7, "c007")]
    assert files.misplaced(chunks, ids).count() == 0 and files.misplaced(chunks.filter("chunk_id != 'c001'"), ids).first().status == "no_chunk"


def test_viewer_markup():
    root = markup.tree('<p class="section-1">A</p><p>x</p><p class="section-2">B</p><table class="a nb"><tr><td colspan="2">(단위 : 원)</td></tr><tr><td>p</td><td>q</td></tr></table><p class="section-1">C</p><p class="cover-title">D</p>')
    nested = markup.nest_sections(root)
    assert [(x.tag, next(x.find("title")).text(), [y.tag for y in x.nodes()]) for x in nested.nodes()] == [("section-1", "A", ["title", "p", "section-2"]), ("section-1", "C", ["title"]), ("cover", "D", ["title"])]
    assert markup.retag_values(root) == 1 and [c.tag for c in root.find("td", "te")] == ["te", "td", "td"]
    root = markup.tree('<p>see <a href="u">the  page</a> <a>none</a> <span class="x noprint">no</span>!</p><table><thead><tr><td>h</td></tr></thead><tr><td>b</td></tr></table>')
    markup.rewrite_links(root)
    markup.strip_noprint(root)
    assert " ".join(next(root.find("p")).text().split()) == "see [the page](u) none !"
    assert [markup.inside(tr, "thead") for tr in root.find("tr")] == [True, False]


def test_plain_markup_reads_as_the_standard_tokenizer_does():
    rng = random.Random(3)
    parts = ["<table>", "</table>", "<tr>", "<td>", "<td colspan=2>", '<td a="x y" b=1>', '<td a="">', "</td>", "<p>", "<br>", "text", "a > b", "\n", "<li>", "<b>", "</b>", "</x>", "<td a= 1>", "<br/>", "<T>", "< a", "<", "&amp;", "<title>", '<td a="1"b=2>', "<td  a=1>", "<td a='1'>", "<td a=1", "</p >", "<td a=1 a=2>", '<td a=">">']
    show = lambda n: (n.tag, n.attrs, [show(x) if isinstance(x, markup.Node) else x for x in n.content])
    plain = 0
    for _ in range(20000):
        source = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        b = markup._Builder()
        b.feed(source)
        b.close()
        plain += markup._plain_tree(source) is not None
        assert show(markup.tree(source)) == show(b.root)
    assert plain > 2000


def test_equal_sources_are_parsed_once(monkeypatch):
    """Also when more sources than the memory holds come between, with the results of the plain way."""
    seen = []
    monkeypatch.setattr(markup, "tree", lambda source, f=markup.tree: seen.append(source) or f(source))
    sources = [f"<table><tr><td colspan={i % 3 + 1}>{i % 50}</td><td>x</td></tr></table>" for i in range(300)]
    read = markup.Memory(markup.blocks)
    assert [read(x)[0] for x in sources] == [list(markup.blocks(markup.tree(x))) for x in sources]
    assert len(seen) == 150 + 300
    small = markup.Memory(markup.blocks, 1 << 14)
    assert [small(x)[0] for x in sources] == [read(x)[0] for x in sources] and small.old and small.size <= small.limit


def test_blocks_of_many_and_large_documents_keep_their_keys(spark):
    rows = [(i, None if i % 7 == 0 else f"<p>{i % 11}</p>" * (40000 if i % 500 == 3 else 1)) for i in range(2500)]
    got = markup.parse_blocks(spark.createDataFrame(rows, "k long, html string").coalesce(1), "k", "html").groupBy("k").agg(F.count("*").alias("n"), F.max("text").alias("t")).collect()
    assert {(r.k, r.n, r.t) for r in got} == {(i, 40000 if i % 500 == 3 else 1, str(i % 11)) for i, x in rows if x}

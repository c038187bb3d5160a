"""The pipeline's stages, each against a plain version on what it was given."""

import random

import pandas as pd
import pytest

import corpus_pipeline
from docloom.llm import rules

from .test_llm import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "d")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(spark, sf_dir, kept):
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(df.columns == names for df in kept[:-1])


def test_rules(spark, sf_dir, kept):
    got = rules.verdict(rules.ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))).filter("kept").toPandas()
    assert sorted(got.doc_id) == sorted(r.doc_id for r in kept[0].collect())


def test_clean_documents_stay(sf_dir, kept):
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet")
    before = pd.read_parquet(f"{sf_dir}/documents.parquet")
    long = before[before.text.str.split().str.len() >= 50]
    good = set(labels[labels.quality == 1].doc_id) & set(long.doc_id)
    stay = {r.doc_id for r in kept[1].collect()}
    assert len(good & stay) >= 0.97 * len(good) and not set(labels[labels.quality == 0].doc_id) & stay


def test_one_of_each_group(kept):
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    comp = plain_components([r[0] for r in rows], [plain_fingerprint(t) for _, t in rows])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(set(comp))


def test_packing_has_all(kept):
    got = kept[3].toPandas()
    assert set(got.doc_id) == {r.doc_id for r in kept[2].collect()}
    assert (got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first()).all()


def test_repeated_rows_leave_one(spark, sf_dir):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, text + " more"), (4, None), (5, ""), (1, "another text " * 40)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.STAGES[2][1](spark, docs, sf_dir).collect()
    prints = [plain_fingerprint(t or "") for _, t in rows]
    groups = plain_components(list(range(len(rows))), prints)  # by place, so that ids don't merge texts
    want = [min((r for r, k in zip(rows, groups, strict=True) if k == g), key=lambda r: (r[0] is None, r[0])) for g in set(groups)]
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((i, t or "") for i, t in want)


def test_unlinked_texts_with_one_id_stay(spark, sf_dir):
    """Components are of texts: neither null ids nor an id on different texts merges them."""
    texts = [" ".join(f"{w}{i}" for i in range(80)) for w in "abcde"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3]), (9, texts[4]), (None, texts[4])]
    random.Random(2).shuffle(rows)
    assert len({plain_fingerprint(t) for t in texts}) == 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.STAGES[2][1](spark, docs, sf_dir).collect()]
    assert sorted(got, key=lambda r: r[1]) == list(zip([None, None, 7, 7, 9], texts, strict=True))


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_awkward_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeats and columns whose names the stages use themselves; and no rows at all."""
    good = "The river ran past the old mill, and the people of the town went by on their way to the market. "
    rnd = random.Random(3)
    words = good.split()
    text = lambda: " ".join(rnd.choice(words) + rnd.choice(["", "", ".", ","]) for _ in range(120))
    own = [text() for _ in range(30)]
    rows = [*enumerate(own), (None, own[3]), (None, text()), (None, None), (50, None), (51, ""), (5, own[5]), (5, own[5]), (6, text()), (60, " ".join(own) * 20)]
    names = ["n", "id", "none", "tie", "whole", "k", "root", "fp", "__n", "__id", "row", "score", "failures", "kept", "c0"]
    docs = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "lang": "en", "source": "s", "n_chars": 1} | {c: f"keep {c}" for c in names})
    labels = pd.DataFrame({"doc_id": pd.array([*range(30)], "Int64"), "quality": pd.array([1] * 30, "Int32"), "toxic": pd.array([0] * 30, "Int32")})
    for name, n in (("full", None), ("none", 0)):
        (tmp_path / name).mkdir()
        docs.head(len(docs) if n is None else n).to_parquet(tmp_path / name / "documents.parquet")
        labels.head(len(labels) if n is None else n).to_parquet(tmp_path / name / "labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    now, path = spark.read.parquet(str(tmp_path / "full" / "documents.parquet")), str(tmp_path / "full")
    plain = now.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now, plain = stage(spark, now, path), stage(spark, plain, path)
        got = [r.asDict() for r in now.collect()]
        assert now.columns == docs.columns.tolist() and all(r[c] == f"keep {c}" for r in got for c in names)
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
        assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(((r.doc_id, r.text) for r in plain.collect()), key=key)
    assert len(got) and corpus_pipeline.run(spark, path).select("doc_id").distinct().count() > 0

"""Operators without SQL against plain versions: sketches, trees, FTRL, samples, ORC files, pieces."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from docloom.llm import langid, packing, quality, sketch, token_orc
from docloom.llm.queries import ORACLE_SQL, QUERIES

from .test_llm import awkward, texts  # noqa: F401  fixtures


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_sketch(text):
    """Hashes and fingerprint by the definition: XXH64 of words, and of five word hashes, below a quarter of 48 bits."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return set(), ""

    def chain(hs):
        seed = 42
        for h in hs:
            seed = xxhash.xxh64_intdigest(signed(h).to_bytes(8, "little", signed=True), seed)
        return seed >> 16

    hs = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    found = {chain(hs[i : i + 5]) for i in range(max(1, len(hs) - 4))}
    kept = {h for h in found if h < (1 << 48) // 4}
    key = "=" + f"{xxhash.xxh64_intdigest(' '.join(words).encode(), 42):016x}"
    return kept, "".join(f"{h:012x}" for h in sorted(kept)) or key


def plain_likeness(a, b):
    (x, p), (y, q) = plain_sketch(a), plain_sketch(b)
    return len(x & y) / len(x | y) if x or y else float(p == q)


@pytest.mark.parametrize("hot", [False, True])
def test_sketch_is_the_plain_one(spark, awkward, tmp_path, hot):  # noqa: F811
    d, rows = awkward
    if hot:  # null ids and one id with many texts
        words = [f"w{i}" for i in range(40)]
        rnd = random.Random(6)
        rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else i, " ".join(rnd.choices(words, k=rnd.choice([2, 4, 30]))), None) for i in range(500)] + [(77, "the same", None)] * 200
        d = str(tmp_path)
        pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows]}).to_parquet(tmp_path / "documents.parquet")
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1].encode(), 42)), r[1]))
    want = Counter()
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        want[-1 if i is None else i, plain_sketch(t)[1], plain_sketch(e)[1], round(plain_likeness(t, e), 9), round(plain_likeness(t, n), 9)] += 1
    got = QUERIES["op2_sketch"](spark, d).toPandas()
    assert Counter((-1 if pd.isna(a) else int(a), f, g, round(x, 9), round(y, 9)) for a, f, g, x, y in zip(got.doc_id, got.fingerprint, got.edited_fingerprint, got.near_edited, got.near_next, strict=True)) == want
    if hot:
        placed = sketch.with_next(spark.read.parquet(f"{d}/documents.parquet")).filter(~F.col("extra"))
        assert placed.groupBy("bucket", "part").agg(F.countDistinct("hash").alias("n")).agg(F.max("n")).first()[0] < 60


def test_containment_of_very_unequal_documents(spark):
    """Of short texts within a long one: 1 if anything was sampled, and null if not; of strange ones 0."""
    words = [f"w{i}" for i in range(4000)]
    rows = [(" ".join(words[i : i + n]), " ".join(words), True) for n in (6, 10, 40) for i in range(0, 3900, 100)] + [(" ".join(f"x{i}{k}" for k in range(12)), " ".join(words), False) for i in range(40)]
    df = spark.createDataFrame(rows, "a string, b string, within boolean").select("within", sketch.sketch(F.col("a")).alias("x"), sketch.sketch(F.col("b")).alias("y"))
    got = df.select("within", sketch.containment(F.col("x"), F.col("y")).alias("c"), F.size("x").alias("n")).collect()
    assert all((r.c is None) == (r.n == 0) and r.c in (None, 1.0 if r.within else 0.0) for r in got)
    assert 0.5 < sum(r.c is not None for r in got) / len(got) < 1
    assert 900 <= len(plain_sketch(" ".join(words))[0]) <= 1100


def test_ablation_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(c.sql(ORACLE_SQL["rules_ablation"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["rules_ablation"](spark, sf_dir).collect()) == want


def plain_statistics(text):
    space = r"[^\x20\x09-\x0D]+"
    w, lines = re.findall(space, text), [x for x in text.split("\n") if re.search(space, x)]
    n, chars = max(1, len(w)), sum(map(len, w))
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = len({i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)})
    count = lambda rule: len(re.findall(rule, text))
    wide, size = max(1, chars), [len(x.encode()) for x in w]
    return [math.log1p(len(w)), chars / n, len(set(w)) / n, repeated / n, math.log1p(len(lines)), (len(lines) - len(set(lines))) / max(1, len(lines)), count(r"[#*$%&|<>]") / n, count("[A-Z]") / wide, count("[0-9]") / wide, count("!") / n, count(r"\|") / n, count(r"\.") / n, count(",") / n, count(r"[^\x00-\x7f]") / wide, sum(x <= 2 for x in size) / n, sum(x > 12 for x in size) / n]


def plain_tree_score(model, x):
    total = model.base
    for feature, bound, leaf in zip(model.feature, model.bound, model.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if x[feature[node]] > bound[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-total))


def test_quality_is_the_plain_walk(spark, awkward):  # noqa: F811
    d, rows = awkward
    model = quality.train(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    assert len(model.feature)
    got = QUERIES["op4_quality"](spark, d).toPandas()
    want = Counter((-1 if i is None else i, round(plain_tree_score(model, plain_statistics(t or "")), 6)) for i, t, _ in rows)
    assert Counter((-1 if pd.isna(i) else int(i), round(s, 6)) for i, s in zip(got.doc_id, got.score, strict=True)) == want


def test_samples_keep_their_bounds(spark):
    """Neither a repeated id nor repeated rows exceed them."""
    rows = [(7, f"one id and many texts {i}", "en") for i in range(200)] + [(8, "the same row", "fr")] * 50 + [(i, f"a text of its own {i}", "en" if i % 2 else "fr") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.sample(docs, 600).count() == 62 and langid.sample(docs, 10).count() == 20 and langid.sample(docs, 10, 15).count() == 15
    labels = spark.createDataFrame([(7, 1), (7, 0), (7, 1), (8, 1)] + [(i, i % 2) for i in range(100, 160)], "doc_id long, quality int")
    usable = {i for i in [7, 8, *range(100, 160)] if zlib.crc32(str(i).encode()) % 5}
    got = [tuple(r) for r in quality.sample(docs, labels).select("doc_id", "quality").collect()]
    assert len(got) == len(usable) and {i for i, _ in got} == usable and (7 not in usable or (7, 0) in got)
    assert quality.sample(docs, labels, 20).count() == 20


def test_langid_is_plain_ftrl():
    """The textbook update, one coordinate after another."""
    rnd = random.Random(9)
    rows = [(np.array(sorted(rnd.sample(range(12), 4))), np.array([rnd.randrange(1, 4) for _ in range(4)]), rnd.choice(["de", "en", "fr"])) for _ in range(30)]
    idf = np.linspace(1, 2, 12)
    model = langid.fit(rows, idf)
    langs, alpha, beta, l1, l2 = ["de", "en", "fr"], 0.5, 1.0, 0.01, 0.01
    z, n = defaultdict(float), defaultdict(float)

    def weight(f, y):
        return 0.0 if abs(z[f, y]) <= l1 else -(z[f, y] - math.copysign(l1, z[f, y])) / ((beta + math.sqrt(n[f, y])) / alpha + l2)

    def values(f, c):
        v = [(1 + math.log(k)) * idf[j] for j, k in zip(f, c, strict=True)]
        size = math.sqrt(sum(x * x for x in v))
        return {int(j): a / size for j, a in zip(f, v, strict=True)} | {12: 1.0}

    order = np.random.default_rng(7)
    for _ in range(3):
        for i in order.permutation(len(rows)):
            f, c, lang = rows[i]
            x = values(f, c)
            logit = [sum(a * weight(j, y) for j, a in x.items()) for y in range(3)]
            e = [math.exp(t - max(logit)) for t in logit]
            step = [((j, y), a * (e[y] / sum(e) - (langs[y] == lang))) for j, a in x.items() for y in range(3)]
            for k, move, g in [(k, g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * weight(*k), g) for k, g in step]:
                z[k] += move
                n[k] += g * g
    want = np.array([[weight(f, y) for y in range(3)] for f in range(13)])
    assert model.langs == langs and np.allclose(model.weight, want, atol=1e-9)

    def loss(t):
        total = 0.0
        for f, c, lang in rows:
            logit = sum(a * want[j] for j, a in values(f, c).items()) / t
            total -= math.log(np.exp(logit[langs.index(lang)]) / np.exp(logit).sum())
        return total

    assert all(loss(model.temperature) <= loss(model.temperature * k) + 1e-6 for k in (0.9, 1.1) if 0.05 <= model.temperature * k <= 20)


def test_orc_has_run_lengths_indexes_and_bloom_filters(spark, awkward, tmp_path):  # noqa: F811
    path = str(tmp_path / "t")
    token_orc.write_tokens(spark.read.parquet(f"{awkward[0]}/documents.parquet"), path, row_index_stride=1000)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    orc, seen = jvm.org.apache.orc.OrcFile, 0
    for file in tmp_path.glob("t/*.orc"):
        reader = orc.createReader(jvm.org.apache.hadoop.fs.Path(str(file)), orc.readerOptions(conf))
        assert reader.getRowIndexStride() == 1000
        column = {name: reader.getSchema().findSubtype(name).getId() for name in reader.getSchema().getFieldNames()}
        rows = reader.rows()
        for stripe in reader.getStripes():
            footer = rows.readStripeFooter(stripe)
            kinds = {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
            ids = column["ids"] + 1  # the elements of the list
            assert footer.getColumns(ids).getKind().toString() == "DIRECT_V2"  # integer run-length encoding, version 2
            assert {(column["doc_id"], "BLOOM_FILTER_UTF8"), (column["doc_id"], "ROW_INDEX"), (ids, "ROW_INDEX")} <= kinds
            assert not any(k.startswith("BLOOM") for c, k in kinds if c != column["doc_id"])
            seen += 1
    assert seen


def test_pieces_of_rows_with_one_id_are_told_apart(spark, awkward):  # noqa: F811
    rows = packing.pack_documents(spark.read.parquet(f"{awkward[0]}/documents.parquet"), with_ids=False).toPandas()
    for _, own in rows.groupby("row"):
        own = own.sort_values("start")
        assert own.start.tolist() == (own.length.cumsum() - own.length).tolist() and own.length.sum() == own.doc_tokens.iloc[0]
    assert rows.row.nunique() == len(awkward[1])

"""Filtered hybrid top-k: dense and sparse scores, hard filters, caps, several entities, and their metrics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.scalars import dot
from docloom.session import ship


def company_filter(name: Column, code: Column, wanted: str) -> Column:
    """Six digits are a code; anything else is looked for in the name."""
    return code == wanted if wanted.isdigit() and len(wanted) == 6 else F.contains(name, F.lit(wanted))


def hard_filter(company: Column | None = None, groups: tuple | None = None, years: tuple | None = None, latest: Column | None = None, group: str = "doc_group", year: str = "base_year", company_drops_latest: bool = False) -> Column:
    """A conjunction of the given filters. `company_drops_latest`: with a company, `latest` is not applied."""
    parts = [F.lit(True)]
    if groups:
        parts.append(F.col(group).isin(*groups))
    if years:
        parts.append(F.col(year).isin(*years))
    if company is not None:
        parts.append(company)
    if latest is not None and not (company is not None and company_drops_latest):
        parts.append(latest)
    return reduce(lambda a, b: a & b, parts)


def dense_scores(index: DataFrame, query: Column, vector: str = "embedding") -> DataFrame:
    return index.withColumn("dense", dot(F.col(vector), query))


def sparse_scores(postings: DataFrame, query: DataFrame, row: str = "row", key: str | None = None) -> DataFrame:
    """Sums of weight products over shared tokens: postings (row, token, weight) with query (token, q_weight, and a key for several queries)."""
    keys = [row] + ([key] if key else [])
    return postings.join(query, "token").groupBy(*keys).agg(F.sum(F.col("weight") * F.col("q_weight")).alias("sparse"))


def weighted(dense: Column, sparse: Column, w_dense: float, w_sparse: float) -> Column:
    return w_dense * dense + w_sparse * F.coalesce(sparse, F.lit(0.0))


def top_k(scored: DataFrame, k: int, row: str = "row", score: str = "score") -> DataFrame:
    """The k best, ties by row, with rank: a partial top-k in every task and one of k rows each."""
    best = scored.orderBy(F.desc(score), row).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), row)).cast("long"))


def top_k_each(scored: DataFrame, by: list[str], k: int, row: str = "row", score: str = "score") -> DataFrame:
    """The k best for each key; Spark cuts each task's rows to k before they are shuffled."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), row)
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def capped_top_k(scored: DataFrame, k: int, cap: int, doc: str, row: str = "row", score: str = "score", by: list[str] | None = None) -> DataFrame:
    """The k best, of each key if any, with at most `cap` of each document: the same as taking greedily in order."""
    w = Window.partitionBy(*(by or []), doc).orderBy(F.desc(score), row)
    kept = scored.withColumn("in_doc", F.row_number().over(w)).filter(F.col("in_doc") <= cap).drop("in_doc")
    return top_k_each(kept, by, k, row, score) if by else top_k(kept, k, row, score)


def interleave(ranked: DataFrame, k: int, entity_order: str, rank: str = "rank", by: list[str] | None = None) -> DataFrame:
    """Lists of several entities in turn, cut to k (for each key if any) and numbered anew as `position`."""
    if by:
        w = Window.partitionBy(*by).orderBy(rank, entity_order)
        return ranked.withColumn("position", F.row_number().over(w).cast("long")).filter(F.col("position") <= k)
    w = Window.orderBy(rank, entity_order)
    return ranked.orderBy(rank, entity_order).limit(k).withColumn("position", F.row_number().over(w).cast("long"))


def entity_quota(k: int, n: int) -> int:
    return -(-k // max(1, n))


def superseded(df: DataFrame, by: list[str], receipt: str, applies: Column | None = None, explicit: str | None = None) -> DataFrame:
    """Adds is_superseded: a greater receipt has the same key. An explicit flag wins, and such rows are not compared."""
    compared = F.lit(True) if applies is None else applies
    if explicit:
        compared = compared & F.col(explicit).isNull()
    latest = F.max(F.when(compared, F.col(receipt))).over(Window.partitionBy(*by))
    found = F.coalesce(compared & (F.col(receipt) < latest), F.lit(False))
    return df.withColumn("is_superseded", F.coalesce(F.col(explicit), found) if explicit else found)


def detect_entities(queries: DataFrame, names: DataFrame, query_id: str, text: str, name: str) -> DataFrame:
    """Names that occur in each text, wherever in a word; the longest first, each at its first place, none within a span already taken; by position.

    `names` is a dictionary: it is met through its first two characters, which every place of a text
    has, so that texts and names join by equality and particles behind a name don't matter.
    """
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    begins = F.array_distinct(F.concat(F.transform(places, lambda i: F.substring(F.col(text), i, F.lit(2))), F.transform(places, lambda i: F.substring(F.col(text), i, F.lit(1)))))
    left = queries.filter(F.length(text) > 0).select(query_id, text, F.explode(begins).alias("__w"))
    right = names.filter(F.length(name) > 0).select(F.col(name), F.substring(name, 1, 2).alias("__w")).distinct()
    met = left.join(right, "__w").withColumn("at", F.instr(F.col(text), F.col(name))).filter("at > 0")
    spans = met.groupBy(query_id).agg(F.array_sort(F.collect_set(F.struct((-F.length(name)).alias("neg"), "at", F.col(name).alias("name")))).alias("s"))
    free = lambda acc, x: ~F.exists(acc, lambda y: (y["at"] < x["at"] - x["neg"]) & (x["at"] < y["at"] - y["neg"]))
    kept = F.aggregate("s", F.slice("s", 1, 0), lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(x))).otherwise(acc))
    return spans.select(query_id, F.explode(kept).alias("k")).select(query_id, F.col("k.name").alias("entity"), F.col("k.at").cast("long").alias("at"))


#: Particles that go with a name that is taken out, and those that join a name to the next.
PARTICLES, JOINING = "와|과|의|은|는|이|가|도|및", "와|과|,"


def subquery(text: Column, keep: Column, others: Column) -> Column:
    """A question about one of several names: each other goes once with a following particle and comma, what joined the kept one goes, blanks collapse; the text itself if nothing is left."""
    quoted = lambda name: F.concat(F.lit(r"(?U)\Q"), name, F.lit(r"\E"))
    out = F.aggregate(others, text, lambda t, name: F.array_join(F.split(t, F.concat(quoted(name), F.lit(f"({PARTICLES})?\\s*,?\\s*")), F.lit(2)), ""))
    out = F.regexp_replace(out, F.concat(F.lit(r"(?U)(\Q"), keep, F.lit(rf"\E)\s*({JOINING})\s*")), F.lit("$1 "))
    out = F.trim(F.regexp_replace(out, r"(?U)\s+", " "))
    return F.when(out != "", out).otherwise(text)


def dense_top_k(index: DataFrame, queries: DataFrame, k: int, row: str, query: str, vector: str = "embedding", digits: int = 6, rows_block: int = 4096, query_block: int = 256) -> DataFrame:
    """The k best rows for each query by inner product, itself left out: query, row, score, rank. Both ids are longs.

    Rows and queries are laid in blocks by their ids; each pair of blocks is one matrix product, of
    which k rows for each query leave the task, and these are ranked.
    """
    lay = lambda df, i, n, names: df.select(F.col(i).alias("i"), F.col(vector).alias("v")).groupBy(F.floor(F.col("i") / n).alias("b")).agg(F.collect_list("i").alias(names[0]), F.flatten(F.collect_list("v")).alias(names[1])).drop("b")
    pairs = lay(index, row, rows_block, ("rows", "r")).crossJoin(lay(queries, query, query_block, ("queries", "q")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, r, queries, q = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(4))
                score = np.round(q.astype(np.float64).reshape(len(queries), -1) @ r.astype(np.float64).reshape(len(rows), -1).T, digits)
                score[queries[:, None] == rows[None, :]] = -np.inf
                best = np.array([np.lexsort((rows, -s))[:k] for s in score]).reshape(len(queries), -1)
                found = np.take_along_axis(score, best, axis=1)
                ok = np.isfinite(found).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(queries, best.shape[1])[ok]), pa.array(rows[best].ravel()[ok]), pa.array(found.ravel()[ok])], [query, row, "score"])

    return top_k_each(pairs.mapInArrow(run, f"`{query}` long, `{row}` long, score double"), [query], k, row)


def round_half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Spark's round of doubles: by their shortest decimal form, halves away from zero."""
    y = np.abs(x) * 10.0**digits
    out = np.copysign(np.floor(y + 0.5) / 10.0**digits, x)
    unsure = np.flatnonzero(np.isfinite(y) & ((np.abs(y - np.floor(y) - 0.5) < 1e-3) | (y > 2.0**40)))
    for i in unsure:  # near a half, or too large for the product to tell
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) if y[i] < 1e20 else x[i]
    return out + 0.0


def _matrix(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as rows in double precision, and which are whole: of that width, without nulls. Others are rows of zeros."""
    whole = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False) == width
    flat = vectors.filter(pa.array(whole)).flatten()
    out = np.zeros((len(vectors), width))
    out[whole] = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(whole.sum(), width)
    if flat.null_count:
        lost = np.zeros(out.shape, bool)
        lost[whole] = flat.is_null().to_numpy(zero_copy_only=False).reshape(whole.sum(), width)
        whole = whole & ~lost.any(axis=1)
        out[~whole] = 0
    return out, whole


def _shared_words(words: pa.Array, codes: np.ndarray, lengths: np.ndarray, toks: pa.Array, part: int = 4096) -> np.ndarray | None:
    """How many of each query's words each text has, as queries by texts; None if no query has words. `part` words at a time."""
    per_query = pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False)
    if not per_query.sum():
        return None
    asked = toks.flatten().dictionary_encode()
    asked_ids = pc.fill_null(asked.indices, -1).to_numpy(zero_copy_only=False)
    number = pc.fill_null(pc.index_in(words, value_set=asked.dictionary), -1).to_numpy(zero_copy_only=False)
    q, d = np.repeat(np.arange(len(toks)), per_query), np.repeat(np.arange(len(lengths)), lengths)
    v = number[codes] if len(words) else np.zeros(0, int)
    out = np.zeros((len(toks), len(lengths)))
    for a in range(0, len(asked.dictionary), part):
        b = min(a + part, len(asked.dictionary))
        left, right = np.zeros((len(toks), b - a), np.float32), np.zeros((len(lengths), b - a), np.float32)
        m, n = (asked_ids >= a) & (asked_ids < b), (v >= a) & (v < b)
        left[q[m], asked_ids[m] - a] = 1
        right[d[n], v[n] - a] = 1
        out += left @ right.T
    return out


def _candidates(score: np.ndarray, margin: np.ndarray, k: int | None, cap: int | None, starts: np.ndarray) -> np.ndarray:
    """Marks a superset of each row's k best, with `cap` of each run of columns, where scores may be wrong by half the margin."""
    n = score.shape[1]
    floor = np.full(len(score), -np.inf)
    if cap is None:
        floor = np.partition(score, n - min(k, n), axis=1)[:, n - min(k, n)]
        return score >= (floor - margin)[:, None]
    lengths, rest, best = np.diff(np.append(starts, n)), score.copy(), []
    for _ in range(cap):
        best.append(np.maximum.reduceat(rest, starts, axis=1))
        rest[rest == np.repeat(best[-1], lengths, axis=1)] = -np.inf  # equal ones go at once, which only lowers the floor
    each = np.concatenate(best, axis=1)
    if k is not None and each.shape[1] >= k:
        floor = np.partition(each, each.shape[1] - k, axis=1)[:, each.shape[1] - k]
    return score >= np.repeat(np.maximum(best[-1], floor[:, None]) - margin[:, None], lengths, axis=1)


def _within(*keys: np.ndarray) -> np.ndarray:
    """The number of each place among the earlier places of its keys."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, int)
    order = np.lexsort((np.arange(n), *keys))
    new = np.append(True, np.any([x[order][1:] != x[order][:-1] for x in keys], axis=0))
    out = np.empty(n, int)
    out[order] = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return out


def text_blocks(rows: DataFrame, row: str, group: str, text: str | None = None, vector: str = "embedding", size: int = 2048) -> DataFrame:
    """Rows laid in blocks where they lie, without an exchange: ids, groups, vectors, and the words of a text, which blanks part, as codes.

    A block has `size` rows at most, and never more than an Arrow batch, which is bounded in bytes.
    """
    ship(rows.sparkSession)
    element = rows.schema[vector].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                texts = pc.split_pattern(part.column(3), " ")
                coded = texts.flatten().dictionary_encode()
                lengths = pc.fill_null(pc.list_value_length(texts), 0)
                found = [part.column(0), part.column(1), part.column(2), coded.dictionary, coded.indices, lengths]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in found], ["ids", "groups", "vectors", "words", "codes", "lengths"])

    chosen = rows.select(F.col(row), F.col(group).cast("string"), F.col(vector), (F.col(text) if text else F.lit(None)).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"ids array<long>, groups array<string>, vectors array<array<{element}>>, words array<string>, codes array<int>, lengths array<int>")


def hybrid_top_k(blocks: DataFrame, queries: DataFrame, settings: list[tuple[float, float]], k: int | None, cap: int | None = None, digits: int = 6) -> DataFrame:
    """The best rows for each query and each setting (w_dense, w_sparse): qid, row, group, w_dense, w_sparse, dense, sparse, score.

    blocks: of `text_blocks`; queries: block, qs array<struct<qid, q, toks>>. dense is the inner product,
    sparse the number of a query's words that the text has, each counted once; score is their weighted
    sum; all are rounded to `digits`. At least one of k, the number of rows, and cap, that of each group,
    is given. Ties go to the smaller row; a null score, of a null or unlike vector, is last.

    Each pair of blocks is one matrix product. What it says within its error of being among the best is
    scored anew, in the order of `dot`, and ranked, so that k rows for each query leave a pair of
    blocks and all scores and ties are those of the plain expressions.
    """
    ship(blocks.sparkSession)
    has_words = F.exists("qs", lambda x: F.size(F.coalesce(x["toks"], F.array())) > 0)
    pairs = blocks.crossJoin(queries.select(F.col("qs.qid").alias("qids"), F.col("qs.q").alias("q"), F.col("qs.toks").alias("toks"), has_words.alias("worded")))
    pairs = pairs.select("ids", "groups", "vectors", *[F.when(F.col("worded"), F.col(c)).alias(c) for c in ("words", "codes", "lengths")], "qids", "q", "toks")
    half, eps = 0.5 * 10.0**-digits, np.finfo(float).eps

    def pair(ids, groups, vectors, words, codes, lengths, qids, q, toks) -> Iterator[list]:
        group_of = pc.dictionary_encode(groups, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        order = np.argsort(group_of, kind="stable") if cap else np.arange(len(ids))
        starts = np.flatnonzero(np.append(True, np.diff(group_of[order]) != 0))
        shared = None if codes is None else _shared_words(words, codes.to_numpy(zero_copy_only=False), lengths.to_numpy(zero_copy_only=False), toks)
        ids, group_of, shared = ids.to_numpy(zero_copy_only=False)[order], group_of[order], None if shared is None else shared[:, order]
        widths = pc.fill_null(pc.list_value_length(q), -1).to_numpy(zero_copy_only=False)
        for width in np.unique(widths):
            mine = np.flatnonzero(widths == width)
            left, known = _matrix(q.take(pa.array(mine)), max(0, width))
            right, whole = _matrix(vectors, max(0, width))
            right, whole = right[order], whole[order] & (width >= 0)
            tame = [(np.abs(x) < 1e100).all(axis=1) for x in (left, right)]  # the others, with NaN too, are always scored anew
            a, b = (np.where(t[:, None], x, 0) if not t.all() else x for t, x in zip(tame, (left, right), strict=True))
            product, words_of = a @ b.T, None if shared is None else shared[mine]
            null = ~(known[:, None] & whole) if not (known.all() and whole.all()) else None
            wild = ~(tame[0][:, None] & tame[1]) if not (tame[0].all() and tame[1].all()) else None
            lengths_of = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1).max(initial=0)
            for number, (w_dense, w_sparse) in enumerate(settings):
                if w_dense == 0 and words_of is None and wild is None and null is None and cap is None:  # every score is zero
                    best = np.argsort(ids, kind="stable")[:k]
                    at, to = np.repeat(np.arange(len(mine)), len(best)), np.tile(best, len(mine))
                else:
                    if w_dense == 0 and wild is None and null is None and cap is None and w_sparse > 4 * half:  # whole numbers of words, told apart by the row
                        approx, margin = words_of * len(ids) - np.argsort(np.argsort(ids, kind="stable")), np.zeros(len(mine))
                    else:
                        approx = w_dense * product if words_of is None else w_dense * product + w_sparse * words_of
                        most = 0.0 if words_of is None else abs(w_sparse) * words_of.max(initial=0)
                        margin = 2.01 * (half * (1 + abs(w_dense)) + 4 * eps * (abs(w_dense) * (width + 2) * lengths_of + most))
                        for none in (null, wild):
                            approx = approx if none is None else np.where(none, -np.inf, approx)
                    found = _candidates(approx, margin, k, cap, starts)
                    at, to = np.nonzero(found if wild is None else found | wild)
                dense = np.zeros(len(at))
                for j in range(width):
                    dense += left[at, j] * right[to, j]
                sparse = np.zeros(len(at)) if words_of is None else words_of[at, to]
                score = round_half_up(w_dense * round_half_up(dense, digits) + w_sparse * sparse, digits)
                last = np.zeros(len(at), bool) if null is None else null[at, to]
                none = np.isnan(score) & ~last
                rank = np.lexsort((ids[to], -np.where(last | none, 0, score), ~none, last, at))
                if cap is not None:
                    rank = rank[_within(group_of[to[rank]], at[rank]) < cap]
                if k is not None:
                    rank = rank[_within(at[rank]) < k]
                at, to = at[rank], to[rank]
                yield [qids.take(pa.array(mine[at])), pa.array(ids[to]), groups.take(pa.array(order[to])), pa.array(np.full(len(at), number, np.int32)), pa.array(dense[rank], mask=last[rank]), pa.array(sparse[rank].astype(np.int64))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for found in pair(*(c[i].values for c in batch.columns)):
                    yield pa.RecordBatch.from_arrays(found, ["qid", "row", "group", "setting", "dense", "sparse"])

    rows = pairs.mapInArrow(run, "qid long, row long, `group` string, setting int, dense double, sparse long")
    weights = F.array(*[F.struct(F.lit(float(a)).alias("w_dense"), F.lit(float(b)).alias("w_sparse")) for a, b in settings])
    rows = rows.withColumn("w", weights[F.col("setting")]).select("qid", "row", "group", "w.*", F.round("dense", digits).alias("dense"), "sparse")
    rows = rows.withColumn("score", F.round(F.col("w_dense") * F.col("dense") + F.col("w_sparse") * F.col("sparse"), digits))
    by = ["qid", "w_dense", "w_sparse"]
    if k is None:
        return top_k_each(rows, [*by, "group"], cap)
    return top_k_each(rows, by, k) if cap is None else capped_top_k(rows, k, cap, "group", by=by)


def sparse_top_k(postings: DataFrame, queries: DataFrame, k: int, row: str = "row", key: str = "query") -> DataFrame:
    """The k rows with the greatest sums of weight products over shared tokens, for each query: key, row, score, rank.

    postings: row, token, weight; queries: key, token, q_weight, which Spark sends to every task if they
    are small. Postings are laid by row once, so that a row's sums are made where they lie and tasks
    send k rows for each query, however frequent a token is.
    """
    scored = postings.repartition(row).join(queries, "token").groupBy(row, key).agg(F.sum(F.col("weight") * F.col("q_weight")).alias("score"))
    return top_k_each(scored, [key], k, row)


def metrics(hits: DataFrame, by: list[str], k: int, ok: str = "ok", rank: str = "rank", company_ok: str | None = None) -> DataFrame:
    """hit_1, hit_k, and mrr by key over ranked hits; null where nothing is expected (ok is null).

    With company_ok also company_1, company_k (the share of hits) and strict_1: the first hit is of the
    right company and section; null where no company is expected.
    """
    first = F.min(F.when(F.col(ok), F.col(rank)))
    some = F.count(ok) > 0
    as_number = lambda c: F.when(some, c.cast("double"))
    at_one = lambda c: F.max(F.when(F.col(rank) == 1, c.cast("double")))
    company = [] if company_ok is None else [
        at_one(F.col(company_ok)).alias("company_1"),
        F.avg(F.col(company_ok).cast("double")).alias("company_k"),
        at_one(F.when(F.col(company_ok).isNotNull(), F.col(company_ok) & F.coalesce(F.col(ok), F.lit(False)))).alias("strict_1"),
    ]
    return hits.filter(F.col(rank) <= k).groupBy(*by).agg(
        as_number(F.coalesce(F.bool_or(F.col(ok) & (F.col(rank) == 1)), F.lit(False))).alias("hit_1"),
        as_number(F.coalesce(F.bool_or(ok), F.lit(False))).alias("hit_k"),
        F.when(some, F.coalesce(1 / first, F.lit(0.0))).alias("mrr"),
        *company,
    )


def entity_coverage(wanted: Column, found: Column) -> Column:
    """The share of wanted entities that were found; null for fewer than two."""
    return F.when(F.size(wanted) >= 2, F.size(F.array_intersect(wanted, found)) / F.size(wanted))


def means(rows: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Means that skip nulls, and how many values each has."""
    each = [f for c in columns for f in (F.avg(c).alias(c), F.count(c).alias(f"n_{c}"))]
    return rows.groupBy(*(by or [])).agg(*each)

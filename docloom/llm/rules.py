"""Quality rules as a bitmask ledger.

Every rule is evaluated once for a document. Its measurements and one bit for each failed rule are
kept; a policy is a versioned mask of the rules that reject, so that policies can change, and their
ablations be counted, without reading texts again.

Nulls: a null text has no words and fails the rule on length; a null doc_id stays null. Repeated rows
are judged each. An empty table gives no rows. Whole texts are read in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, blocks, documents, id_and_text, text_bytes, write_table
from .common import per_row as sums

#: Rules in the order of their bits, each with the condition under which a document fails it.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "capitals": "100 * n_upper > 60 * word_chars",
    "shouting": "100 * n_exclaim > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "digits": "100 * n_digits > 50 * word_chars",
}
#: Policies by version: the rules that reject under each.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: tuple(RULES),
}
BASE, CURRENT = 1, 2
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_digits")

_IS_SPACE, _IS_SYMBOL, _IS_UPPER, _IS_DIGIT = (np.zeros(256, np.uint8) for _ in range(4))
_IS_SPACE[list(SPACE)] = 1
_IS_SYMBOL[list(b"#*$%&|<>")] = 1
_IS_UPPER[65:91] = 1
_IS_DIGIT[48:58] = 1


def policy_mask(version: int) -> int:
    names = list(RULES)
    return sum(1 << names.index(x) for x in POLICIES[version])


def repeated_words(words: list[list[bytes]], n: int = 3) -> np.ndarray:
    """For each text, its words in n-word windows that it has twice or more."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for row in words for w in row], np.int64)
    row = np.repeat(np.arange(len(words)), counts)
    if len(ids) < n:
        return np.zeros(len(words), np.int64)
    starts = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
    bits = max(1, len(index).bit_length())
    if n * bits + max(1, len(words).bit_length()) <= 63:
        key = row[starts].copy()
        for k in range(n):
            key = key << bits | ids[starts + k]
    else:  # number the pairs before a third word is added, so that keys fit
        key = row[starts].copy()
        for k in range(n):
            key = np.unique(key, return_inverse=True)[1] * np.int64(len(index)) + ids[starts + k]
    _, inverse, found = np.unique(key, return_inverse=True, return_counts=True)
    again = starts[found[inverse] > 1]
    marked = np.zeros(len(ids), bool)
    for k in range(n):
        marked[again + k] = True
    return np.bincount(row[marked], minlength=len(words))


def lines_of(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier one."""
    if b"\n" not in text:
        return int(bool(text.strip(SPACE))), 0
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines), len(lines) - len(set(lines))


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, 4_000_000):
        raw, at = text_bytes(block.column(1))
        space = _IS_SPACE[raw]
        letter = (raw & 0xC0) != 0x80
        data, ends = raw.tobytes(), at.tolist()
        texts = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        words = [x.split() for x in texts]
        lines = np.array([lines_of(x) for x in texts], np.int64).reshape(-1, 2)
        found = {
            "n_words": np.fromiter(map(len, words), np.int64, len(words)),
            "word_chars": sums(letter & (space == 0), at),
            "n_symbols": sums(_IS_SYMBOL[raw], at),
            "n_dup_lines": lines[:, 1],
            "n_repeat_words": repeated_words(words),
            "n_lines": lines[:, 0],
            "n_upper": sums(_IS_UPPER[raw], at),
            "n_exclaim": sums(raw == 33, at),
            "n_digits": sums(_IS_DIGIT[raw], at),
        }
        yield pa.RecordBatch.from_arrays([block.column(0), *block.columns[2:], *(pa.array(found[x]) for x in MEASURES)], [*block.schema.names[:1], *block.schema.names[2:], *MEASURES])


def ledger(docs: DataFrame, *more: F.Column) -> DataFrame:
    """doc_id, further columns, the measurements, and failures: a bit for each failed rule."""
    rows = id_and_text(docs, *more)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    found = rows.mapInArrow(_measure, kept + "".join(f", {x} long" for x in MEASURES))
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return found.withColumn("failures", total)


def verdict(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """Adds policy (its version) and kept: no rule of the policy failed."""
    return rows.withColumn("policy", F.lit(version)).withColumn("kept", F.col("failures").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablation(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of the policy: documents that fail it, that only it rejects, and that stay without it."""
    mask = policy_mask(version)
    fails = F.col("failures").bitwiseAND(F.lit(mask))
    names = [x for x in RULES if x in POLICIES[version]]
    each = []
    for x in names:
        bit = 1 << list(RULES).index(x)
        each.append(F.struct(F.lit(x).alias("rule"), F.count_if(fails.bitwiseAND(F.lit(bit)) != 0).alias("failed"), F.count_if(fails == bit).alias("failed_only_this"), F.count_if(fails.bitwiseAND(F.lit(~bit)) == 0).alias("kept_without")))
    return rows.agg(F.array(*each).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of documents, written once and read back: policies and ablations need no texts."""
    return write_table(ledger(documents(spark, sf_dir)), "rule-ledger")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = verdict(stored_ledger(spark, sf_dir))
    failed = F.col("failures").bitwiseAND(F.lit(policy_mask(BASE))) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept", "failures", "policy")


def ablation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ablation(stored_ledger(spark, sf_dir))


#: The same in SQL: windows by position, lines by number.
SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
h AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
p AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM h, (VALUES (0), (1), (2)) v(k) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT t.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
             CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclaim,
             CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits
      FROM t JOIN w USING (r)),
a AS (SELECT m.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM m LEFT JOIN p USING (r) LEFT JOIN l USING (r)),
f AS (SELECT *, CAST({bits} AS BIGINT) AS failures FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & {base}) <> 0 AS base_failed, (failures & {mask}) = 0 AS kept, failures, {version} AS policy
FROM f
""".format(bits=" + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values())), base=policy_mask(BASE), mask=policy_mask(CURRENT), version=CURRENT)

ABLATION_SQL = f"WITH ledger AS ({SQL}), r(rule, bit) AS (VALUES " + ", ".join(f"('{x}', {1 << list(RULES).index(x)})" for x in RULES if x in POLICIES[CURRENT]) + f""")
SELECT rule, count(*) FILTER (WHERE failures & bit <> 0) AS failed, count(*) FILTER (WHERE failures & {policy_mask(CURRENT)} = bit) AS failed_only_this,
       count(*) FILTER (WHERE (failures & {policy_mask(CURRENT)}) - (failures & bit) = 0) AS kept_without
FROM r CROSS JOIN ledger GROUP BY rule"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current policy keeps."""
    whole = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("whole")
    kept = verdict(ledger(docs, whole)).filter("kept")
    return kept.select(*[F.col(f"whole.c{i}").alias(c) for i, c in enumerate(docs.columns)])

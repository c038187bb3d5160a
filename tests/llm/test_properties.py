"""Properties on generated inputs."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docloom.llm import bpe, packing, quality, rules, tokens
from docloom.llm.common import blocks, text_bytes

TEXT = st.text(st.characters(blacklist_categories=("Cs",)), max_size=80) | st.text("ab 'strevml d\n\t.é1", max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


@pytest.fixture(scope="module")
def coder():
    return bpe.NumpyBPE(tokens.default_path(), cache=2000, piece=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_bpe_is_the_library_s(library, coder, rows):
    ids, at = coder.encode(rows)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]
    assert coder.decode(ids, at) == rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60))
def test_packing_is_whole_and_full(lengths):
    windows, rest = packing.pack([(i, 0, n) for i, n in enumerate(lengths)], final=True)
    assert not rest
    got = sorted(p for w in windows for p in w)
    for i, n in enumerate(lengths):
        own, at = [p for p in got if p[0] == i], 0
        for _, start, length in own:
            assert start == at
            at += length
        assert at == n
    assert all((s := sum(p[2] for p in w)) <= 1024 and s & (s - 1) == 0 for w in windows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 60))
def test_blocks_have_every_row(rows, size):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], ["doc_id", "text"])
    parts = list(blocks([batch], size))
    assert [t for p in parts for t in p.column(1).to_pylist()] == rows
    for p in parts:
        raw, at = text_bytes(p.column(1))
        assert [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)] == [t or "" for t in p.column(1).to_pylist()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \n\t#!A1é", max_size=60), min_size=1, max_size=5))
def test_measures(rows):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], ["doc_id", "text"])
    got = next(iter(rules._measure([batch]))).to_pylist()
    for t, m in zip(rows, got, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"]) == (len(words), sum(map(len, words)), t.count("#"), len(lines) - len(set(lines)))
        assert m["n_repeat_words"] == len({i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)})
    assert np.isfinite(quality.statistics(batch.column(1))).all()

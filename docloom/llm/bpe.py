"""Byte-level BPE in numpy: merge rounds over the symbols of many words in one flat array.

Each round finds the lowest-ranked pair of every word by binary search over sorted pair keys and
merges it everywhere in its word. Decoding gathers the bytes of tokens from one flat table.

Nulls: a null text is empty; a null doc_id stays null. Empty texts have no ids. Repeated rows each
have their result. An empty table gives no rows. Texts are cut into words piece by piece.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import blocks, documents, id_and_text, take_ragged
from .tokens import CACHE_WORDS, ENCODE_BYTES, PIECE, WordIds, _loaded, byte_letters, default_path

NONE = np.int32(2**31 - 1)


class NumpyBPE(WordIds):
    def __init__(self, path: str, cache: int = CACHE_WORDS, piece: int = PIECE):
        super().__init__(cache, piece)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.first = np.array([vocab[x] for x in letters], np.int32)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.tokens = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.added = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.tokens, key=len, reverse=True))) + b")") if self.tokens else None
        value = {x: b for b, x in enumerate(letters)}
        names: list[bytes] = [b""] * (max([*vocab.values(), *self.tokens.values()]) + 1)
        for token, i in vocab.items():
            names[i] = bytes(value[x] for x in token)
        for token, i in self.tokens.items():
            names[i] = token
        self.bytes, self.bytes_at = self._table(names)
        self.digits, self.digits_at = self._table([b"%d," % i for i in range(len(names))])

    @staticmethod
    def _table(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)

    def special(self, text: bytes) -> list[tuple[bytes, int | None]] | None:
        if self.added is None or not self.added.search(text):
            return None
        return [(x, self.tokens.get(x)) for x in self.added.split(text) if x]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return self.merge(self.first[np.frombuffer(b"".join(words), np.uint8)], lengths)

    def merge(self, sym: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words and their lengths, after every merge that applies."""
        done_sym, done_row = [], []
        row = np.repeat(np.arange(len(lengths)), lengths)
        last = np.ones(len(sym), bool)
        last[:-1] = row[:-1] != row[1:]
        rank = np.full(len(sym), NONE, np.int32)
        inner = np.flatnonzero(~last)
        rank[inner] = self._rank(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            sizes = np.diff(np.append(starts, len(sym)))
            low = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = low == NONE
            if over.any():
                done_sym.append(sym[over])
                done_row.append(row[over])
                keep = ~over
                sym, row, last, rank, low = sym[keep], row[keep], last[keep], rank[keep], low[keep]
                if not len(sym):
                    break
            hit = rank == low
            if (hit[1:] & hit[:-1]).any():  # of overlapping pairs, as in "aaa", every second one counts, from the left
                at = np.flatnonzero(hit)
                begin = np.concatenate([[True], np.diff(at) > 1])
                nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
                hit[at[nth % 2 == 1]] = False
            at = np.flatnonzero(hit)
            sym[at] = self.merged[rank[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, row, last, rank = sym[keep], row[keep], last[keep], rank[keep]
            at = place[at]
            before = at[at > 0] - 1
            fresh = np.unique(np.concatenate([at, before[~last[before]]]))
            rank[fresh] = NONE
            fresh = fresh[~last[fresh]]
            rank[fresh] = self._rank(sym[fresh], sym[fresh + 1])
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
        sym, row = np.concatenate(done_sym), np.concatenate(done_row)
        return sym[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(lengths))

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """Texts of the rows of ids; bytes that are no UTF-8 become U+FFFD."""
        raw, lengths = take_ragged(self.bytes, self.bytes_at, ids)
        ends = np.concatenate([[0], np.cumsum(lengths)])[at].tolist()
        data = raw.tobytes()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decimals(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Each row's ids as decimals joined by commas."""
        raw, lengths = take_ragged(self.digits, self.digits_at, ids)
        ends = np.concatenate([[0], np.cumsum(lengths)])[at].tolist()
        data = raw.tobytes()
        return [data[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def numpy_bpe(path: str) -> NumpyBPE:
    """One coder for a worker process."""
    if (path, "numpy") not in _loaded:
        _loaded[path, "numpy"] = NumpyBPE(path)
    return _loaded[path, "numpy"]


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ids of every whole text."""
    path = tokenizer or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, ENCODE_BYTES):
            ids, at = numpy_bpe(path).encode(block.column(1))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the text of `ids`; null ids give a null text."""
    path = tokenizer or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            rows, flat = ids.to_pylist(), ids.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum([len(x or ()) for x in rows])]).astype(np.int64)
            texts = numpy_bpe(path).decode(flat, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else t for x, t in zip(rows, texts, strict=True)], pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids as decimals and of the text decoded from them."""
    path = tokenizer or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = numpy_bpe(path)
        for block in blocks(batches, ENCODE_BYTES):
            ids, at = coder.encode(block.column(1))
            ids_sha = [hashlib.sha256(x).hexdigest() for x in coder.decimals(ids, at)]
            decoded = [hashlib.sha256(x.encode()).hexdigest() for x in coder.decode(ids, at)]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(np.diff(at)), pa.array(ids_sha), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))

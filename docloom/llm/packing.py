"""Hierarchical packing of documents into token windows of several lengths.

A document's ids are cut into windows of the longest tier while they fill one; the rest is routed to
the shortest tier that holds it. Windows are opened from the longest tier down and each is filled
with what its own tier and shorter ones have, best fit first; where nothing fits, a shorter piece is
cut, so that windows are full. What is left at the end of a partition goes into windows of powers of
two, full as well. Windows are then dealt over step groups so that tokens and attention cost balance.

Nulls: a null text is empty and has only the end id; a null doc_id stays null. Repeated rows are
packed each. An empty table gives no rows. Memory is bounded by the pool and one document.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import blocks, documents, id_and_text
from .tokens import ENCODE_BYTES, default_path, library_ids

TIERS = (128, 256, 512, 1024)
#: Tokens that are packed together, and tokens of a step group.
POOL_TOKENS, STEP_TOKENS = 2_000_000, 64 * 1024
PART_BITS = 40


class Pool:
    """Pieces by length; a bit for each length that has some."""

    def __init__(self):
        self.by, self.bits = defaultdict(list), 0

    def add(self, piece: tuple) -> None:
        self.by[piece[2]].append(piece)
        self.bits |= 1 << piece[2]

    def take(self, most: int | None = None, least: bool = False) -> tuple | None:
        """The longest piece of at most `most` ids, or the shortest of all."""
        bits = self.bits if most is None else self.bits & ((2 << most) - 1)
        if not bits:
            return None
        n = (bits & -bits).bit_length() - 1 if least else bits.bit_length() - 1
        piece = self.by[n].pop()
        if not self.by[n]:
            self.bits &= ~(1 << n)
        return piece


def pack(pieces: Iterable[tuple], tiers: tuple[int, ...] = TIERS, final: bool = False) -> tuple[list[list[tuple]], list[tuple]]:
    """Windows, each a list of pieces (document, start, length), and the pieces that filled none.

    `final`: those too go into windows, of powers of two.
    """
    pool, windows, longest = Pool(), [], max(tiers)
    for doc, start, length in pieces:
        while length > longest:
            windows.append([(doc, start, longest)])
            start, length = start + longest, length - longest
        if length == longest:
            windows.append([(doc, start, length)])
        elif length:
            pool.add((doc, start, length))
    rest: list[tuple] = []
    while (piece := pool.take()) is not None:
        size = next(t for t in sorted(tiers) if t >= piece[2])
        window, gap = [piece], size - piece[2]
        while gap:
            if (piece := pool.take(gap)) is None:
                if (piece := pool.take(least=True)) is None:
                    break
                doc, start, length = piece
                pool.add((doc, start + gap, length - gap))
                piece = (doc, start, gap)
            window.append(piece)
            gap -= piece[2]
        if gap:
            rest = window
        else:
            windows.append(window)
    if final and rest:
        left = sum(x[2] for x in rest)
        while left:
            gap, window = 1 << (left.bit_length() - 1), []
            left -= gap
            while gap:
                doc, start, length = rest.pop(0)
                if length > gap:
                    rest.insert(0, (doc, start + gap, length - gap))
                    length = gap
                window.append((doc, start, length))
                gap -= length
            windows.append(window)
        rest = []
    return windows, rest


def step_groups(windows: list[list[tuple]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each window: by falling length and attention cost, dealt to and fro."""
    sizes = [sum(x[2] for x in w) for w in windows]
    groups = max(1, round(sum(sizes) / step_tokens))
    order = sorted(range(len(windows)), key=lambda i: (-sizes[i], -sum(x[2] ** 2 for x in windows[i]), i))
    out = [0] * len(windows)
    for n, i in enumerate(order):
        turn, at = divmod(n, groups)
        out[i] = groups - 1 - at if turn % 2 else at
    return out


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, tiers: tuple[int, ...] = TIERS, pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS, with_ids: bool = True) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, row, and ids if asked for.

    Partitions are packed as they are read, with no shuffle; sequence_id, step_group and row carry the
    partition's number in their high bits. `row` numbers the table's rows, and so tells pieces of rows
    apart that have one doc_id.
    """
    path, kind = tokenizer or default_path(), docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "row"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = library_ids(path), TaskContext.get().partitionId() << PART_BITS
        pending: dict[int, tuple] = {}  # documents with pieces to place: their id, count of ids, and ids
        pieces: list[tuple] = []
        waiting = number = sequence = group = 0

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pieces, sequence, group, waiting
            windows, rest = pack(pieces, tiers, final)
            groups, rows, kept = step_groups(windows, step_tokens), [], []
            for window, g in zip(windows, groups, strict=True):
                size, offset = sum(x[2] for x in window), 0
                for doc, start, length in window:
                    doc_id, total, ids = pending[doc]
                    own = ids[start : start + length]
                    rows.append((doc_id, start, length, zlib.crc32(own), total, base + sequence, offset, size, base + group + g, base + doc))
                    kept.append(own)
                    offset += length
                sequence += 1
            group += max(groups, default=-1) + 1
            left = {x[0] for x in rest}
            for doc in [x for x in pending if x not in left]:
                del pending[doc]
            pieces, waiting = rest, sum(x[2] for x in rest)
            for at in range(0, len(rows), 50_000):
                arrays = [pa.array(x, docs_type if k == 0 else pa.int64()) for k, x in enumerate(zip(*rows[at : at + 50_000], strict=True))]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32).tolist() for x in kept[at : at + 50_000]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        docs_type = pa.int64()
        for block in blocks(batches, ENCODE_BYTES):
            docs_type = block.column(0).type
            ids, at = encoder.encode(block.column(1))
            ids = np.insert(ids, at[1:], end_id).astype("<u4")
            at = (at + np.arange(len(at))).tolist()
            for doc_id, a, b in zip(block.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                pending[number] = (doc_id, b - a, ids[a:b])
                pieces.append((number, 0, b - a))
                number, waiting = number + 1, waiting + b - a
            if waiting >= pool_tokens:
                yield from flush(False)
        yield from flush(True)

    longs = ", ".join(f"{x} long" for x in names[1:])
    return id_and_text(docs).mapInArrow(run, f"doc_id {kind}, {longs}" + ", ids array<int>" * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), with_ids=False)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, with_ids=False)

"""Language-model scoring: a gated recurrent network with a class-factored softmax, and unigram counts.

Words are counted over all training documents. The most frequent ones (VOCABULARY) are the network's
words. It is trained in numpy by truncated backpropagation on every word of every training document:
documents go by a hash to ROUNDS rounds and within a round to shards of about SHARD_WORDS words, so that
neither depends on how the table is split. A shard reads its documents in the order of their hashes, in
lanes side by side, window after window with the state carried on; the parameters of a round's shards
are averaged by their words, and the next round goes on from there. A document is scored from its
beginning to its end with the state carried from window to window. A word outside the vocabulary has
the probability that the network gives to any such word, times its share in the smoothed counts of
those words. Counts of all but the HELD most frequent words stay distributed and are joined to the rare
words of documents.

Nulls: a null text is empty, which has one token, the end; a null doc_id counts as crc32 of the empty
text and stays null. Repeated rows are scored each, and trained on each: the k-th repeat that a task
meets has a hash of its own, so that a row repeated without end does not fill one shard (only there may
the split of the table show in a score). Texts of any length are read whole; only their numbers, two
bytes a word, are held at once. Ties in counts are broken by the word. An empty table gives no rows;
with no training rows all counts are zero.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import ship

from .common import SPACE, blocks, documents, drop_table, id_and_text, remainder, text_bytes, write_table
from .simhash import LOWER

#: Words of the network (with the end and "any other" they fit 16 bits); words whose counts every task holds.
VOCABULARY, HELD = 2048, 100_000
HIDDEN = 16
#: Rounds of averaging; words of a shard and of a file of shards, about.
ROUNDS, SHARD_WORDS, FILE_WORDS = 4, 800_000, 32_000_000
#: Steps of a window of training; lanes are as many as give about LANE_WORDS words each, within bounds.
WINDOW, LANE_WORDS, LANES = 20, 3000, (4, 256)
#: Step sizes of the first round and of the last step.
RATE, LAST_RATE = 0.012, 0.0005
#: Texts that are read side by side, and words whose probabilities are taken together, about.
SCORED_LANES, SCORED_WORDS = 1024, 1 << 14
#: How many counted words a task holds before it sends them on.
COUNTER_WORDS = 300_000
END = b""


_LOWER = np.frombuffer(LOWER, np.uint8)
_IN_WORD = np.isin(np.arange(256), list(SPACE), invert=True)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER).split()


def cut(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and where each text's begin, with the end; as words_of() of each, without a Python object for a word."""
    raw, at = text_bytes(column)
    inside, new = _IN_WORD[raw], np.zeros(len(raw) + 1, bool)
    new[at] = True  # no word goes on in the next text
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | new[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | new[1:-1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end)
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin + 1, out=offsets[1:])
    data = _LOWER[raw[inside]]
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.searchsorted(begin, at)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: defaultdict[bytes, int] = defaultdict(int)

    def send() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
        found.clear()
        return batch

    for block in blocks(batches):
        coded = cut(block.column(1))[0].dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        for word, k in zip(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), n.tolist(), strict=True):
            found[word] += k
        found[END] += block.num_rows
        if len(found) > COUNTER_WORDS:
            yield send()
    if found:
        yield send()


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n over all texts; the empty word is the end of a text."""
    return id_and_text(docs).mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def classes_of(counts: np.ndarray) -> np.ndarray:
    """A class for each word, by falling counts: each class has about the same sum of root counts."""
    n = max(1, round(len(counts) ** 0.5 / 2))
    mass = np.cumsum(np.sqrt(counts + 1.0))
    return np.minimum((mass - mass[0]) / mass[-1] * n, n - 1).astype(np.int64)


def _shifts(w: np.ndarray, b: np.ndarray, first: np.ndarray) -> list:
    """For each class a number to be taken from its logits before exp: states lie within 1, which bounds the logits, so that mostly one serves all rows; None if not."""
    reach = np.abs(w).sum(axis=1)
    most, least = (np.maximum.reduceat(x, first[:-1]) for x in (b + reach, b - reach))
    return [x if x - y < 60 else None for x, y in zip(most, least, strict=True)]


def _softmax(hs: np.ndarray, w: np.ndarray, b: np.ndarray, shift: np.floating | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, their exponentials and the rows' sums."""
    logit = hs @ w
    if shift is None:
        logit += b
        logit -= logit.max(axis=1, keepdims=True)
    else:
        logit += b - shift
    e = np.exp(logit)
    return logit, e, e @ np.ones(e.shape[1], e.dtype)


class Adam:
    """Moments of the gradients; a step is cut to a norm."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.m, self.v, self.t = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0

    def step(self, p: dict[str, np.ndarray], grads: dict[str, np.ndarray], rate: float, most: float = 5.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            g = g * np.float32(min(1.0, most / (norm + 1e-9)))
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g**2 - v)
            p[k] -= np.float32(rate / (1 - 0.9**self.t)) * m / (np.sqrt(v * np.float32(1 / (1 - 0.99**self.t))) + np.float32(1e-8))


@dataclass
class Network:
    """The parameters by name; words are sorted by class, so that those of class c lie from first[c] to first[c + 1]."""

    klass: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @cached_property
    def first(self) -> np.ndarray:
        return np.searchsorted(self.klass, np.arange(self.klass[-1] + 2))

    @classmethod
    def new(cls, counts: np.ndarray, hidden: int = HIDDEN, seed: int = 11) -> Network:
        """counts: of the network's words, falling."""
        klass, rng = classes_of(counts), np.random.default_rng(seed)
        klass = np.unique(klass, return_inverse=True)[1]
        r = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        n, c = len(counts), int(klass[-1]) + 1
        own = np.log(counts + 1.0).astype(np.float32)
        return cls(klass, {"e": r(hidden, n).T.copy(), "wx": r(hidden, 3 * hidden), "bx": np.zeros(3 * hidden, np.float32), "u": r(hidden, 3 * hidden), "cw": 0.1 * r(hidden, c), "cb": np.log(np.bincount(klass, counts + 1.0)).astype(np.float32), "ww": 0.1 * r(hidden, n).T.copy(), "wb": own})

    def table(self) -> np.ndarray:
        """What each word as input adds to the gates."""
        return self.p["e"] @ self.p["wx"] + self.p["bx"]

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        k = h.shape[1]
        g = h @ self.p["u"]
        zr = 1 / (1 + np.exp(-(x[:, : 2 * k] + g[:, : 2 * k])))
        z, r = zr[:, :k], zr[:, k:]
        n = np.tanh(x[:, 2 * k :] + r * g[:, 2 * k :])
        return n + z * (h - n), z, r, n, g[:, 2 * k :]

    def log_probability(self, hs: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The natural log of each target's probability given the states."""
        p, rows = self.p, np.arange(len(hs))
        order, hs, target, bounds = self._by_class(hs, target)
        logit, _, total = _softmax(hs, p["cw"], p["cb"], _shifts(p["cw"].T, p["cb"], np.array([0, len(p["cb"])]))[0])
        found = logit[rows, self.klass[target]] - np.log(total)
        for i, j, a, b, shift in bounds:
            logit, _, total = _softmax(hs[i:j], p["ww"][a:b].T, p["wb"][a:b], shift)
            found[i:j] += logit[rows[: j - i], target[i:j] - a] - np.log(total)
        out = np.empty_like(found)
        out[order] = found
        return out

    def gradient(self, hs: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray]) -> np.ndarray:
        """The gradient of the targets' negative log-probabilities by the states; those by the softmax parameters go to grads."""
        p, rows = self.p, np.arange(len(hs))
        order, hs, target, bounds = self._by_class(hs, target)
        _, e, total = _softmax(hs, p["cw"], p["cb"], _shifts(p["cw"].T, p["cb"], np.array([0, len(p["cb"])]))[0])
        e /= total[:, None]
        e[rows, self.klass[target]] -= 1
        one = np.ones(len(hs), e.dtype)
        grads |= {"cw": hs.T @ e, "cb": one @ e, "ww": np.zeros_like(p["ww"]), "wb": np.zeros_like(p["wb"])}
        dh = e @ p["cw"].T
        for i, j, a, b, shift in bounds:
            own, w = hs[i:j], p["ww"][a:b]
            _, e, total = _softmax(own, w.T, p["wb"][a:b], shift)
            e /= total[:, None]
            e[rows[: j - i], target[i:j] - a] -= 1
            grads["ww"][a:b] = e.T @ own
            grads["wb"][a:b] = one[: j - i] @ e
            dh[i:j] += e @ w
        out = np.empty_like(dh)
        out[order] = dh
        return out

    def _by_class(self, hs: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
        """Rows in the order of their targets, and so by class; for each class of several words that is met its rows, words and shift."""
        order = np.argsort(target.astype(np.int16), kind="stable")
        hs, target, first = hs[order], target[order], self.first
        at, words, shifts = np.searchsorted(target, first).tolist(), first.tolist(), _shifts(self.p["ww"], self.p["wb"], first)
        return order, hs, target, [(at[c], at[c + 1], words[c], words[c + 1], shifts[c]) for c in range(len(shifts)) if at[c] < at[c + 1] and words[c + 1] - words[c] > 1]

    def train(self, stream: np.ndarray, end: int, rate: float = RATE, last: float = LAST_RATE, window: int = WINDOW) -> int:
        """Truncated backpropagation over a stream of words that begins with an end; every other word is a target once.

        The stream is cut into lanes of one length, or one word less, that are read side by side with the
        state carried on; it starts anew behind an end. Returns the number of targets.
        """
        n = len(stream) - 1
        if n < 1:
            return 0
        lanes = min(n, max(LANES[0], min(LANES[1], n // LANE_WORDS)))
        bounds = np.array([i * n // lanes for i in range(lanes + 1)])
        bounds = bounds[np.argsort(-np.diff(bounds), kind="stable")] if n % lanes else bounds[:-1]  # the longer lanes first
        length, full = -(-n // lanes), n % lanes or lanes
        at = bounds + np.arange(length)[:, None]
        h, adam = np.zeros((lanes, self.p["u"].shape[0]), np.float32), Adam(self.p)
        whole = length if full == lanes else length - 1
        for a in range(0, whole, window):
            b = min(whole, a + window)
            h, grads = self._window(stream[at[a:b]], stream[at[a:b] + 1], h, end)
            adam.step(self.p, grads, rate + (last - rate) * a / length)
        if whole < length:  # the last word of the longer lanes
            x = at[whole:, :full]
            adam.step(self.p, self._window(stream[x], stream[x + 1], h[:full], end)[1], last)
        return n

    def _window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, end: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The state behind the window and the mean gradients, for words x and their successors y by step and lane."""
        p, k, (steps, lanes) = self.p, h.shape[1], x.shape
        gates = self.table()[x]
        kind = gates.dtype
        fresh = (x != end).astype(kind)[:, :, None]
        was, n, hn, hs = (np.empty((steps, lanes, k), kind) for _ in range(4))
        zr = np.empty((steps, lanes, 2 * k), kind)
        for t in range(steps):
            np.multiply(h, fresh[t], out=was[t])
            g = was[t] @ p["u"]
            gate = gates[t, :, : 2 * k] + g[:, : 2 * k]
            np.exp(np.negative(gate, out=gate), out=gate)
            gate += 1
            np.reciprocal(gate, out=zr[t])
            hn[t] = g[:, 2 * k :]
            new = zr[t, :, k:] * hn[t]
            new += gates[t, :, 2 * k :]
            np.tanh(new, out=n[t])
            np.subtract(was[t], n[t], out=new)
            new *= zr[t, :, :k]
            h = np.add(new, n[t], out=hs[t])
        grads: dict[str, np.ndarray] = {}
        dh = self.gradient(hs.reshape(-1, k), y.ravel(), grads).reshape(steps, lanes, k)
        z, r = zr[:, :, :k], zr[:, :, k:]
        by_z, by_n, by_r = (was - n) * z * (1 - z), (1 - z) * (1 - n * n), hn * r * (1 - r)
        dx, dg = np.empty_like(gates), np.empty_like(gates)
        carry, back = np.zeros_like(h), np.ascontiguousarray(p["u"].T)
        for t in range(steps - 1, -1, -1):
            d = dh[t]
            d += carry
            np.multiply(d, by_z[t], out=dg[t, :, :k])
            dn = np.multiply(d, by_n[t], out=dx[t, :, 2 * k :])
            np.multiply(dn, by_r[t], out=dg[t, :, k : 2 * k])
            np.multiply(dn, r[t], out=dg[t, :, 2 * k :])
            carry = dg[t] @ back
            d *= z[t]
            carry += d
            carry *= fresh[t]
        dx[:, :, : 2 * k] = dg[:, :, : 2 * k]
        flat, words = dx.reshape(-1, 3 * k), x.ravel()
        order = np.argsort(words.astype(np.int16), kind="stable")
        words = words[order]
        at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        de = np.zeros_like(p["e"])
        de[words[at]] = np.add.reduceat((flat @ p["wx"].T)[order], at, axis=0)
        grads |= {"u": was.reshape(-1, k).T @ dg.reshape(-1, 3 * k), "bx": flat.sum(axis=0), "wx": p["e"][x.ravel()].T @ flat, "e": de}
        for g in grads.values():
            g *= kind.type(1 / x.size)
        return hs[-1].copy(), grads

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = values[at : at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n

    def copy(self) -> Network:
        return Network(self.klass, {k: v.copy() for k, v in self.p.items()})

    def score(self, flat: np.ndarray, at: np.ndarray, end: int, lanes: int = SCORED_LANES, together: int = SCORED_WORDS) -> np.ndarray:
        """The natural log-likelihood of each row of words, whole; row i lies from at[i] to at[i + 1] and has its end already.

        Rows of about one length are read side by side, the longest first, so that those still read are always the first.
        """
        lengths, table = np.diff(at), self.table()
        out, order = np.zeros(len(lengths)), np.argsort(-lengths, kind="stable")
        for a in range(0, len(order), lanes):
            self._score(flat, at[:-1], lengths, order[a : a + lanes], table, end, together, out)
        return out

    def _score(self, flat: np.ndarray, at: np.ndarray, lengths: np.ndarray, order: np.ndarray, table: np.ndarray, end: int, together: int, out: np.ndarray) -> None:
        falling, begin = lengths[order], at[order]
        h = np.zeros((len(order), self.p["u"].shape[0]), table.dtype)
        last = np.full(len(order), end, flat.dtype)
        total, states, targets, held = np.zeros(len(order)), [], [], 0
        # rows longer than t, for each t
        still = len(order) - np.searchsorted(falling[::-1], np.arange(falling[0]), side="right")
        for t, b in enumerate(still.tolist()):
            h[:b] = self.step(table[last[:b]], h[:b])[0]
            last[:b] = flat[begin[:b] + t]
            states.append(h[:b].copy())
            targets.append(last[:b].copy())
            held += b
            if held >= together or t == len(still) - 1:
                found, i = self.log_probability(np.concatenate(states), np.concatenate(targets)), 0
                for x in states:
                    total[: len(x)] += found[i : i + len(x)]
                    i += len(x)
                states, targets, held = [], [], 0
        out[order] = total


class _Known(dict):
    """Places of the words whose counts are held; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Model:
    """Counts of the held words, by falling count, and the network over the first of them.

    Numbers of the network: its words by class, among them OTHER (any word outside) and the end.
    """

    words: list[bytes]
    counts: np.ndarray
    size: int  # of the vocabulary
    total: int
    types: int
    number: np.ndarray  # of each held word in the network
    end: int
    network: Network
    others: float  # smoothed counts of all words outside the vocabulary, and of one unknown

    @classmethod
    def new(cls, words: list[bytes], counts: np.ndarray, total: int, types: int, vocabulary: int = VOCABULARY) -> Model:
        ends = [i for i, w in enumerate(words) if w == END]
        end_count = int(counts[ends[0]]) if ends else 0
        plain = [i for i, w in enumerate(words) if w != END][:vocabulary]
        inside = np.zeros(len(words), bool)
        inside[plain] = True
        inside[ends] = True
        rest = total - int(counts[inside].sum())
        own = np.concatenate([counts[plain], [rest, end_count]]).astype(np.int64)
        order = np.argsort(-own, kind="stable")
        place = np.empty(len(own), np.int64)
        place[order] = np.arange(len(own))
        number = np.full(len(words), place[-2])
        number[plain], number[ends] = place[: len(plain)], place[-1]
        return cls(words, counts, len(plain), total, types, number, int(place[-1]), Network.new(own[order]), rest + types - int(inside.sum()) + 1)


class Reader:
    """A model as a worker uses it."""

    def __init__(self, model: Model):
        self.model, self.known = model, _Known(zip(model.words, range(len(model.words)), strict=True))
        self.log = np.log10(model.counts + 1.0)
        counts = np.bincount(model.number, minlength=len(model.network.klass))
        inner = [i for i, w in enumerate(model.words) if w != END][: model.size]
        self.inside = np.zeros(len(model.words) + 1, bool)
        self.inside[inner] = True
        taken = np.zeros(len(counts), bool)
        taken[model.number[inner]] = True
        taken[model.end] = True
        self.other = int(np.flatnonzero(~taken)[0])
        self.number = np.append(model.number, self.other)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Places of words among the held, -1 for rarer ones."""
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def network_numbers(self, held: np.ndarray) -> np.ndarray:
        """The network's numbers of words, by their places among the held."""
        return np.where(self.inside[held], self.number[held], self.other).astype(np.int16)


_readers: dict[int, Reader] = {}


def _reader(shared) -> Reader:
    if shared.value.get("key") not in _readers:
        _readers.clear()
        _readers[shared.value["key"]] = Reader(shared.value["model"])
    return _readers[shared.value["key"]]


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most `most` words, all that have a count or none: those from the smallest eighth of a power of two on that leaves no more.

    A histogram of at most some hundred steps finds it, so that tasks send only the words that are kept.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r["step"]: r["size"] for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("size")).collect()}
    total, least = 0, max(sizes, default=0) + 1
    for k in sorted(sizes, reverse=True):
        if (total := total + sizes[k]) > most:
            break
        least = k
    return counts.filter(step >= least)


def begin(counts: DataFrame, vocabulary: int = VOCABULARY, held: int = HELD) -> Model:
    """A model with the counts, and a network that knows no more than these yet."""
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts, held).toPandas().sort_values(["n", "word"], ascending=[False, True])
    return Model.new([bytes(w) for w in top["word"]], top["n"].to_numpy(np.int64), total, types, vocabulary)


def tokenize(docs: DataFrame, model: Model, *more: F.Column) -> DataFrame:
    """A row of each text as the model reads it: doc_id, further columns, its hash, the network's numbers and what the counts say."""
    rows = id_and_text(docs, F.xxhash64(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.coalesce(docs["text"], F.lit(""))).alias("hash"), *more)
    shared = docs.sparkSession.sparkContext.broadcast({"key": uuid.uuid4().hex, "model": model})
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("text", "hash"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = _reader(shared), Counter()
        log, inside = np.append(reader.log, 0.0), reader.inside
        rest = np.where(inside, 0.0, log - np.log10(model.others))
        for block in blocks(batches):
            words, at = cut(block.column(1))
            coded = words.dictionary_encode()
            index = coded.indices.to_numpy()
            distinct = reader.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            places = distinct[index]
            n = np.diff(at)
            # each text's numbers, and the end behind them
            flat = np.full(len(places) + len(n), model.end, np.int16)
            flat[np.arange(len(places)) + np.repeat(np.arange(len(n)), n)] = reader.network_numbers(distinct)[index]
            bounds = 2 * (at + np.arange(len(at)))
            numbers = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
            few = places < 0
            many = np.concatenate([[0], np.cumsum(few)])[at]
            rare = pa.LargeListArray.from_arrays(pa.array(many), coded.dictionary.take(pa.array(index[few]))).cast(pa.list_(pa.binary()))
            sums = [np.diff(np.concatenate([[0.0], np.cumsum(x[distinct][index])])[at]) for x in (log, rest)]
            keys = []
            for key in block.column(2).to_pylist():
                keys.append((key + seen[key] * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63))
                seen[key] += 1
            arrays = [block.column(0), *block.columns[3:], pa.array(keys, pa.int64()), numbers, pa.array(n + 1), pa.array(n - np.diff(many)), pa.array(sums[0]), pa.array(sums[1]), rare]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *block.schema.names[3:], *TOKENIZED])

    found = rows.mapInArrow(run, f"{kept}, " + ", ".join(f"{k} {v}" for k, v in TOKENIZED.items()))
    return found.withColumn("__row", F.monotonically_increasing_id())


#: What tokenize() adds to a row, beside its number __row.
TOKENIZED = {"__key": "long", "__numbers": "binary", "__n": "long", "__known": "long", "__logs": "double", "__rests": "double", "__rare": "array<binary>"}


def _shards(batches: Iterable[pa.RecordBatch], end: int) -> Iterator[np.ndarray]:
    """The streams of successive rows of one shard (columns shard, key, numbers), each begun with an end."""
    held, shard = [], None
    for batch in batches:
        for s, numbers in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if s != shard and held:
                yield np.concatenate([np.array([end], np.int16), *held])
                held = []
            shard = s
            held.append(np.frombuffer(numbers, np.int16))
    if held:
        yield np.concatenate([np.array([end], np.int16), *held])


def learn(rows: DataFrame, model: Model, rounds: int = ROUNDS, shard_words: int = SHARD_WORDS) -> int:
    """Trains the model's network on every word of tokenized rows; returns the number of words, the same as the model's total if the rows are its own.

    The rows' hashes alone place them in rounds and shards, which lie in one exchange side by side: each
    round reads its own files and sends the driver one set of parameters, whatever the size of the table.
    """
    spark = rows.sparkSession
    per_round = max(1, round(model.total / rounds / shard_words))
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = min(per_round, max(2 * wide, -(-model.total // rounds // FILE_WORDS)))
    place = F.pmod("__key", F.lit(rounds * per_round))
    placed = rows.select((place % rounds).cast("int").alias("round"), F.floor(place / rounds).cast("long").alias("shard"), F.col("__key").alias("key"), F.col("__numbers").alias("numbers"))
    placed = placed.repartitionById(rounds * files, (F.col("round") * files + F.floor(F.col("shard") * files / per_round)).cast("int"))
    table = write_table(placed.sortWithinPartitions("round", "shard", "key"), "lm-shards", by="round")
    total = 0
    for k in range(rounds):
        rate = RATE + (LAST_RATE - RATE) * k / rounds
        last = RATE + (LAST_RATE - RATE) * (k + 1) / rounds
        shared = spark.sparkContext.broadcast({"key": uuid.uuid4().hex, "model": model})

        def run(batches: Iterable[pa.RecordBatch], shared=shared, rate=rate, last=last) -> Iterator[pa.RecordBatch]:
            start, total, n = shared.value["model"], 0.0, 0
            for stream in _shards(batches, start.end):
                own = start.network.copy()
                seen = own.train(stream, start.end, rate, last)
                total, n = total + own.flat().astype(np.float64) * seen, n + seen
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), n, np.int64))], ["i", "v", "n"])

        part = table.filter(F.col("round") == k).select("shard", "key", "numbers")
        found = part.mapInArrow(run, "i int, v double, n long").groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas().sort_values("i")
        if len(found):  # as many rows as the network has parameters
            model.network.set_flat((found["v"] / found["n"]).to_numpy())
            total += int(found["n"].iloc[0])
        shared.unpersist()
    drop_table(table)
    return total


def train(docs: DataFrame, vocabulary: int = VOCABULARY, held: int = HELD, rounds: int = ROUNDS, shard_words: int = SHARD_WORDS) -> tuple[Model, DataFrame]:
    """A model of the documents, and the table of all word counts."""
    counts = write_table(word_counts(docs), "word-counts")
    model = begin(counts, vocabulary, held)
    learn(tokenize(docs, model), model, rounds, shard_words)
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame, *more: F.Column) -> DataFrame:
    """doc_id, further columns, n_tokens, n_known, base_score and score of every whole text."""
    return score_rows(write_table(tokenize(docs, model, *more), "lm-rows"), model, counts)


def score_rows(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """As score(), of rows from a table that tokenize() gave."""
    more = [f for f in rows.schema.fields if f.name not in (*TOKENIZED, "__row")]
    shared = rows.sparkSession.sparkContext.broadcast({"key": uuid.uuid4().hex, "model": model})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value["model"]
        for batch in batches:
            numbers = batch.column(0)
            flat = np.frombuffer(b"".join(numbers.to_pylist()), np.int16)
            sizes = np.array(batch.column(1), np.int64)
            found = own.network.score(flat, np.concatenate([[0], np.cumsum(sizes)]), own.end) / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(found)], [*batch.schema.names[2:], "__own"])

    kept = [F.col(f"`{f.name}`") for f in more]
    network = rows.select("__numbers", "__n", *kept, F.col("__n").alias("n_tokens"), "__known", "__logs", "__rests", "__row")
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in network.schema.fields[2:])
    scored = network.mapInArrow(run, f"{given}, __own double")
    rare = rows.select("__row", F.explode("__rare").alias("word"))
    met = rare.join(counts, "word").groupBy("__row").agg(F.count("*").alias("__met"), F.sum(F.log10(F.col("n") + 1.0)).alias("__more"))
    both = scored.join(met, "__row", "left").na.fill({"__met": 0, "__more": 0.0})
    end = counts.filter(F.col("word") == F.lit(bytearray(END))).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]
    known = F.col("__known") + F.col("__met") + F.lit(int(end > 0))
    base = F.col("__logs") + F.col("__more") + float(np.log10(end + 1)) - F.col("n_tokens") * float(np.log10(model.total + model.types + 1))
    return both.select(*kept, "n_tokens", known.alias("n_known"), base.alias("base_score"), (F.col("__own") + F.col("__rests") + F.col("__more")).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = remainder(docs["doc_id"], 7) == 2
    counts = write_table(word_counts(docs.filter(~held)), "word-counts")
    model = begin(counts)
    rows = write_table(tokenize(docs, model, held.alias("held_out")), "lm-rows")
    learn(rows.filter(~F.col("held_out")), model)
    return score_rows(rows, model, counts).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")

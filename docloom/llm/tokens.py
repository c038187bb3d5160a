"""Byte-level BPE ids of whole texts, by words: each distinct word is encoded once and then looked up.

Texts are cut into words over their bytes in numpy and numbered by Arrow's dictionary encoding, so that
Python sees only the distinct words of a block. A byte-level BPE merges within words only, so that the
ids of a text are those of its words.
"""

from __future__ import annotations

import json
import re
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex

from .common import take_ragged, text_bytes

#: The split rule of the public byte-level BPE vocabularies, which cut() follows.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Words in a worker's cache before those met once are dropped; it bounds memory and changes no result.
CACHE_WORDS = 350_000
#: Bytes of texts that are encoded together.
ENCODE_BYTES = 2_000_000
#: Bytes that are cut into words at once, about.
PIECE = 4 << 20
#: A place at which any text may be cut without changing its words: before a space between two ASCII letters.
SAFE = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")
OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable bytes for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@cache
def classes() -> np.ndarray:
    """OTHER, LETTER, NUMBER or BLANK for each code point."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.zeros(0x110000, np.uint8)
    for kind, rule in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(rule, everything):
            first, last = ord(m[0][0]), ord(m[0][-1])
            table[first : last + 1] = kind
            if first < 0xD800 <= last:
                table[0xD800:0xE000] = OTHER
    return table


def cut(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where words begin, and the end: byte offsets by PATTERN in UTF-8 texts that begin at `starts`."""
    if not len(raw):
        return np.zeros(1, np.int64)
    lead = None
    if raw.max() < 0x80:
        point = raw
    else:
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        point = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        starts = np.searchsorted(lead, starts)
    kind, n = classes()[point], len(point)
    first = np.zeros(n + 1, bool)
    first[starts[starts < n]] = True
    first[0] = first[n] = True
    begin = np.ones(n + 1, bool)
    begin[1:n] = kind[1:] != kind[:-1]
    # behind white space: its last character is a word of its own, or a space that the next word takes
    after = np.flatnonzero(begin[1:n] & ~first[1:n] & (kind[:-1] == BLANK)) + 1
    begin[after] = point[after - 1] != 0x20
    begin[after - 1] = True
    begin |= first
    for ending in ENDINGS:
        marks = np.flatnonzero(point[: n - len(ending)] == 0x27)
        marks = marks[begin[marks]]
        for k, letter in enumerate(ending, 1):
            marks = marks[(point[marks + k] == ord(letter)) & ~first[marks + k]]
        begin[marks + 1] = False
        begin[marks + 1 + len(ending)] = True
    found = np.flatnonzero(begin)
    if lead is not None:
        found = np.append(lead, len(raw))[found]
    return found


def segments(raw: np.ndarray, at: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """The beginnings of texts and, in texts longer than `piece`, safe places to cut them; and the end."""
    long = np.flatnonzero(np.diff(at) > piece)
    if not len(long):
        return at
    more, view = [], memoryview(raw)
    for i in long.tolist():
        place = int(at[i])
        while (m := SAFE.search(view, place + piece, int(at[i + 1]))) is not None:
            place = m.start()
            more.append(place)
    return np.sort(np.concatenate([at, np.array(more, np.int64)]))


class WordIds:
    """Looks up the ids of words; a subclass says how new words are encoded."""

    def __init__(self, cache: int = CACHE_WORDS, piece: int = PIECE):
        self.cache, self.piece = cache, piece
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.done, self.met = 0, np.zeros(0, np.int64)
        self.flat, self.at = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def _thin(self) -> None:
        """Drops words that were met once of late, and the least met beyond half of the cache."""
        keep = np.flatnonzero(self.met[: self.done] > 1)
        if len(keep) > self.cache // 2:
            keep = np.sort(keep[np.argsort(-self.met[keep], kind="stable")[: self.cache // 2]])
        words = list(self.index)
        met, (flat, lengths) = self.met[keep] // 2, take_ragged(self.flat, self.at, keep)
        self._clear()
        self.index = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.done, self.met, self.flat = len(keep), met, flat
        self.at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and their numbers."""
        raise NotImplementedError

    #: What the strings of added tokens match, if there are any.
    added: re.Pattern[bytes] | None = None

    def special(self, text: bytes) -> list[tuple[bytes, int | None]] | None:
        """None for a text without added tokens; else its ordinary parts with None and tokens with their ids."""
        return None

    def _learn(self) -> None:
        new = list(islice(self.index, self.done, None))
        if not new:
            return
        ids, lengths = self.encode_words(new)
        start, end = int(self.at[self.done]), int(self.at[self.done]) + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat[:start], np.zeros(max(end, start), np.int32)])
        if len(self.index) + 1 > len(self.at):
            self.at = np.concatenate([self.at[: self.done + 1], np.zeros(2 * len(self.index), np.int64)])
        self.flat[start:end] = ids
        self.at[self.done + 1 : len(self.index) + 1] = start + np.cumsum(lengths)
        self.done = len(self.index)

    def _ordinary(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and bounds of texts without added tokens."""
        bounds, out, place = segments(raw, at, self.piece), [], [np.zeros(1, np.int64)]
        total = a = 0
        while a < len(bounds) - 1:
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + 2 * self.piece, side="right")) - 1)
            if len(self.index) > self.cache:
                self._thin()
            part = raw[bounds[a] : bounds[b]]
            own = bounds[a : b + 1] - bounds[a]
            words = cut(part, own[:-1])
            column = pa.Array.from_buffers(pa.large_binary(), len(words) - 1, [None, pa.py_buffer(words), pa.py_buffer(part)]).dictionary_encode()
            index, distinct = self.index, column.dictionary.to_pylist()
            found = list(map(index.get, distinct))
            for i in [i for i, n in enumerate(found) if n is None]:
                found[i] = index[distinct[i]] = len(index)
            number = np.array(found, np.int64)
            self._learn()
            rows = number[column.indices.to_numpy()] if len(number) else np.zeros(0, np.int64)
            self.met = np.concatenate([self.met, np.zeros(len(self.index) - len(self.met), np.int64)])
            self.met += np.bincount(rows, minlength=len(self.index))
            ids, lengths = take_ragged(self.flat, self.at, rows)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            pa.default_memory_pool().release_unused()
            out.append(ids)
            place.append(total + ends[np.searchsorted(words, own[1:])])
            total, a = total + len(ids), b
        ends = np.concatenate(place)
        return np.concatenate(out) if out else np.zeros(0, np.int32), ends[np.searchsorted(bounds, at)]

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text begins, with the end."""
        raw, at = text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        data, ends = raw.tobytes(), at.tolist()
        odd = {}
        if self.added is not None and self.added.search(data):
            odd = {i: x for i in range(len(ends) - 1) if (x := self.special(data[ends[i] : ends[i + 1]])) is not None}
        if not odd:
            return self._fixed(raw, at)
        parts, owner, tokens = [], [], []
        for i in range(len(ends) - 1):
            for part, token in odd.get(i, [(data[ends[i] : ends[i + 1]], None)]):
                parts.append(part if token is None else b"")
                owner.append(i)
                tokens.append(-1 if token is None else token)
        ids, bounds = self._fixed(np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64))
        tokens = np.array(tokens)
        here = np.flatnonzero(tokens >= 0)
        lengths = np.diff(bounds) + (tokens >= 0)
        ids = np.insert(ids, bounds[here], tokens[here])
        counts = np.bincount(owner, lengths, len(ends) - 1).astype(np.int64)
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])

    def _fixed(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, ends = self._ordinary(raw, np.unique(at))
        return ids, ends[np.searchsorted(np.unique(at), at)]  # empty texts begin where others do


class LibraryIds(WordIds):
    """Words encoded by the tokenizers library. Texts with added tokens' strings go to it whole."""

    def __init__(self, path: str, cache: int = CACHE_WORDS, piece: int = PIECE):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__(cache, piece)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        split = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) != ("ByteLevel", False, True):
            raise ValueError("a byte-level BPE without normalizer is needed")
        self.added = re.compile(b"|".join(re.escape(x["content"].encode()) for x in spec["added_tokens"])) if spec["added_tokens"] else None
        self.letters = np.array(list(map(ord, byte_letters())), np.uint32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The library's model on each word, in the letters that stand for its bytes."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        letters, encode = self.letters[raw].tobytes().decode("utf-32-le"), self.library.model.tokenize
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))).tolist()
        flat, counts, start = [], [], 0
        for end in ends:
            found = encode(letters[start:end])
            counts.append(len(found))
            flat += [x.id for x in found]
            start = end
        return np.array(flat, np.int32), np.array(counts, np.int64)

    def special(self, text: bytes) -> list[tuple[bytes, int | None]] | None:
        if self.added is None or not self.added.search(text):
            return None
        return [(b"", i) for i in self.library.encode(text.decode(), add_special_tokens=False).ids]


_loaded: dict[tuple, WordIds] = {}


def library_ids(path: str) -> LibraryIds:
    """One encoder for a worker process."""
    if (path, "library") not in _loaded:
        _loaded[path, "library"] = LibraryIds(path)
    return _loaded[path, "library"]

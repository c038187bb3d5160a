"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A text's paragraphs are windows of its words: wherever MIN_CONTAINED of a template's word pairs lie
within WIDTH times its length, the words around them are a paragraph to be classified, whatever the
lines and however long the text. They are found for all texts of a block at once in numpy, by one
search of each word and sums over places, so that the work grows with the words. A sparse multinomial
logistic regression on word n-grams gives a paragraph a licence family or the unknown class. A
prediction counts if its probability reaches MIN_PROBABILITY and the paragraph holds MIN_CONTAINED of a
template of that family; others are unknown. No paragraph that could be confirmed is left out.

The training set is made from the templates and from the sentences below by dropping, swapping and
framing words, so that the model needs no corpus rows. Its temperature and the unknown class's share
are calibrated on templates and sentences that were held out whole: each FOLDS-th part is predicted by
a model of the others.

Nulls: a null text has no licences; a null doc_id stays null. Empty texts have none. Repeated rows are
scanned each. An empty table gives no rows. Texts of any length are scanned whole. Of overlapping
windows the one with the larger share of its template counts, then the longer template, the higher
probability, the earlier place.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, documents, id_and_text, text_bytes

MIN_PROBABILITY, MIN_CONTAINED, FOLDS = 0.5, 0.6, 4
#: A window's width as a multiple of the template's words, and words beside it on its lines that the classifier sees too.
WIDTH, CONTEXT = 1.5, 4
UNKNOWN = "unknown"
#: A point within a word stands before a digit.
WORD = re.compile(r"[a-z0-9]+(?:\.(?=[0-9])[a-z0-9]+)*")

#: Customary licence names and notices by family.
TEMPLATES = {
    "mit": ["mit license", "released under the mit license", "licensed under the mit license", "spdx license identifier mit", "the mit license mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"],
    "apache-2.0": ["apache license version 2.0", "licensed under the apache license version 2.0", "released under the apache license 2.0", "spdx license identifier apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at apache.org licenses license-2.0"],
    "gpl-3.0": ["gpl v3", "gnu gpl version 3", "this work is licensed under the gnu general public license version 3", "licensed under the gnu gpl v3", "spdx license identifier gpl-3.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-2.0": ["gpl v2", "gnu gpl version 2", "licensed under the gnu general public license version 2", "licensed under the gnu gpl v2", "spdx license identifier gpl-2.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "lgpl": ["gnu lgpl", "licensed under the gnu lesser general public license", "spdx license identifier lgpl-2.1", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "agpl-3.0": ["gnu agpl", "licensed under the gnu affero general public license version 3", "spdx license identifier agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation"],
    "bsd": ["bsd license", "released under the bsd license", "licensed under the bsd 3-clause license", "spdx license identifier bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "mpl-2.0": ["mozilla public license", "licensed under the mozilla public license version 2.0", "spdx license identifier mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"],
    "isc": ["isc license", "released under the isc license", "spdx license identifier isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "cc-by": ["cc by 4.0", "creative commons attribution 4.0", "licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-sa": ["cc by-sa 4.0", "creative commons attribution sharealike", "licensed under cc by-sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"],
    "cc-by-nc": ["cc by-nc 4.0", "creative commons attribution noncommercial", "licensed under cc by-nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc0": ["cc0 1.0", "creative commons zero", "released under cc0 1.0", "dedicated to the public domain", "this work has been dedicated to the public domain under the creative commons cc0 waiver"],
    "proprietary": ["all rights reserved", "proprietary and confidential", "copyright all rights reserved", "all rights reserved no part of this work may be reproduced without written permission", "proprietary and confidential unauthorized copying is strictly prohibited"],
}
#: Sentences with words of licences that state none.
OTHERS = [
    "he lost his driving license last year and had to apply again", "the city council will license new taxis next spring", "a fishing license costs more for visitors than for residents", "the court discussed copyright law and its history", "with the permission of the owner we entered the garden",
    "the police obtained a warrant to search the house", "there is no warrant for such a claim", "she asked permission to leave early", "the warranty of the washing machine ends after two years", "wealth was redistributed among the villages", "poetic license lets the author change the order of events",
    "the bar renewed its liquor license", "most songs of that age have fallen out of copyright", "pilots need a license to fly at night", "the dealer offers an extended warranty for the car", "the permission slip must be signed by a parent", "the licensing board met on tuesday", "licensed doctors may open a practice here",
    "the license plate was covered with mud", "copyright debates fill the newspapers", "the apache helicopter landed in version two of the film", "students of mit released a report on the weather", "the software was distributed on disks and sold in shops", "the public library lends books free of charge to any person", "the general public was not admitted to the source of the river", "he works as a gnu keeper in the zoo under a new contract",
]



def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def pairs_of(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False)) or {(w, "") for w in words}


def grams(words: list[str]) -> Counter[str]:
    """Words, pairs and triples of a paragraph."""
    return Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


_FRAMES = ["this project is", "the source code is", "see the file for details", "copyright 2021 the authors", "unless stated otherwise", "please note", "all files", "more on the web page", "dieses werk steht unter der", "ce texte est sous", "este trabajo se publica bajo la", "distributed under", "available under the", "published under", "", ""]


def _variants(text: str, rng: np.random.Generator, n: int) -> Iterator[list[str]]:
    yield from [words_of(text)] * 4
    for _ in range(n):
        words = [w for w in words_of(text) if rng.random() > 0.06]
        if len(words) > 14 and rng.random() < 0.4:
            a = int(rng.integers(0, len(words) - 10))
            words = words[a : a + int(rng.integers(10, len(words)))]
        yield [*_FRAMES[rng.integers(len(_FRAMES))].split(), *words, *_FRAMES[rng.integers(len(_FRAMES))].split()]


def samples(seed: int = 3, n: int = 24) -> list[tuple[list[str], str, int]]:
    """Paragraphs, their families, and the number of the template or sentence that each is made from."""
    rng = np.random.default_rng(seed)
    sources = [(t, family) for family, texts in TEMPLATES.items() for t in texts] + [(t, UNKNOWN) for t in OTHERS]
    rows = [(v, family, i) for i, (t, family) in enumerate(sources) for v in _variants(t, rng, n)]
    pool = [w for t, _ in sources for w in words_of(t)]
    rows += [(rng.choice(pool, int(rng.integers(5, 20))).tolist(), UNKNOWN, len(sources) + i) for i in range(400)]  # the words without their order
    return [rows[i] for i in rng.permutation(len(rows))]


@dataclass
class Classifier:
    families: list[str]
    place: dict[str, int]  # of each n-gram among the weights
    weight: np.ndarray
    temperature: float = 1.0
    unknown: float = 0.0  # what the unknown class has more, after calibration

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [(i, n) for g, n in grams(words).items() if (i := self.place.get(g)) is not None]
        at, n = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
        x = np.minimum(n, 2) / max(1.0, len(n)) ** 0.5
        return np.append(at, len(self.weight) - 1), np.append(x, 1.0)

    def logits(self, words: list[str]) -> np.ndarray:
        at, x = self.features(words)
        return x @ self.weight[at]

    def probabilities(self, words: list[str]) -> np.ndarray:
        x = self.logits(words) / self.temperature
        x[self.families.index(UNKNOWN)] += self.unknown
        e = np.exp(x - x.max())
        return e / e.sum()

    def classify(self, words: list[str]) -> tuple[str, float, float]:
        """The family, its probability, and how much of its nearest template the paragraph holds; unknown if unconfirmed."""
        p = self.probabilities(words)
        family, contained = self.families[int(p.argmax())], 0.0
        if family != UNKNOWN:
            contained = contained_in(words, family)
        if family == UNKNOWN or p.max() < MIN_PROBABILITY or contained < MIN_CONTAINED:
            return UNKNOWN, float(p[self.families.index(UNKNOWN)]), contained
        return family, float(p.max()), contained


def contained_in(words: list[str], family: str) -> float:
    """The largest share of a template's word pairs that a paragraph has."""
    own = pairs_of(words)
    return max(len(own & t.pairs) / len(t.pairs) for t in templates() if t.family == family)


def fit(rows: list[tuple[list[str], str, int]], epochs: int = 6, rate: float = 0.5, decay: float = 1e-5) -> Classifier:
    """Stochastic gradient descent over the rows."""
    families = sorted({*TEMPLATES, UNKNOWN})
    place = {g: i for i, g in enumerate(sorted({g for words, *_ in rows for g in grams(words)}))}
    model = Classifier(families, place, np.zeros((len(place) + 1, len(families))))
    data = [(*model.features(words), families.index(f)) for words, f, _ in rows]
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for at, x, y in data:
            z = x @ model.weight[at]
            e = np.exp(z - z.max())
            g = e / e.sum()
            g[y] -= 1
            x = x.copy()
            x[-1] = 0.1
            model.weight[at] -= step * (x[:, None] * g + decay * model.weight[at])
    return model


def held_out_logits(rows: list[tuple[list[str], str, int]], folds: int = FOLDS) -> tuple[np.ndarray, np.ndarray]:
    """The logits of each row by a model that has seen nothing made from the row's template or sentence, and the right classes."""
    logits, right = [], []
    for k in range(folds):
        model = fit([r for r in rows if r[2] % folds != k])
        for words, family, source in rows:
            if source % folds == k:
                logits.append(model.logits(words))
                right.append(model.families.index(family))
    return np.array(logits), np.array(right)


@cache
def trained() -> Classifier:
    """The model of all rows, with the temperature and the unknown class's share that suit templates and sentences it has not seen."""
    rows = samples()
    model, (x, y) = fit(rows), held_out_logits(rows)
    unknown = np.arange(len(model.families)) == model.families.index(UNKNOWN)

    def loss(t: float, more: float) -> float:
        z = x / t + more * unknown
        top = z.max(axis=1)
        return float((np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[np.arange(len(y)), y]).mean())

    model.temperature, model.unknown = min(((t, m) for t in np.geomspace(0.1, 10, 40).tolist() for m in np.linspace(-3, 3, 25).tolist()), key=lambda c: loss(*c))
    return model


@dataclass(frozen=True)
class Template:
    family: str
    size: int  # words
    pairs: frozenset[tuple[str, str]]

    @property
    def need(self) -> int:
        """Pairs that confirm it."""
        return int(np.ceil(MIN_CONTAINED * len(self.pairs) - 1e-9))

    @property
    def width(self) -> int:
        """Pairs of the widest window."""
        return int(WIDTH * self.size) + 4


@cache
def templates() -> list[Template]:
    return [Template(family, len(words_of(t)), frozenset(pairs_of(words_of(t)))) for family, texts in TEMPLATES.items() for t in texts]


@cache
def _tables() -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The templates' words, the number of each of their pairs by first and second word (-1: none), and which templates have a pair."""
    pairs = sorted({p for t in templates() for p in t.pairs})
    words = sorted({w for p in pairs for w in p})
    place = {w: i for i, w in enumerate(words)}
    number = np.full((len(words) + 1, len(words) + 1), -1, np.int32)
    for k, (a, b) in enumerate(pairs):
        number[place[a], place[b]] = k
    return pa.array([w.encode() for w in words], pa.large_binary()), number, np.array([[p in t.pairs for t in templates()] for p in pairs])


_RAW = np.arange(256)
_LETTER = ((_RAW >= 97) & (_RAW <= 122)) | ((_RAW >= 65) & (_RAW <= 90)) | ((_RAW >= 48) & (_RAW <= 57))
_LOWER = np.where((_RAW >= 65) & (_RAW <= 90), _RAW + 32, _RAW).astype(np.uint8)


def cut(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes and their bounds; the words' first and last bytes, and which of the templates' words each is (none: their number)."""
    raw, at = text_bytes(column)
    inside = _LETTER[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True  # no word goes on in the next text
    point = np.flatnonzero(raw == 46)
    point = point[(point > 0) & (point < len(raw) - 1)]
    point = point[inside[point - 1] & (raw[point + 1] >= 48) & (raw[point + 1] <= 57) & ~edge[point] & ~edge[point + 1]]
    inside[point] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end)
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin + 1, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside]])])
    known = _tables()[0]
    which = pc.fill_null(pc.index_in(words, value_set=known), len(known)).to_numpy()
    return raw, at, begin, end, which


def _best_windows(pos: np.ndarray, pair: np.ndarray, template: Template) -> Iterator[tuple[int, int, int]]:
    """First and last pair and the number of distinct pairs of each window that no neighbour betters; pos rises."""
    left, right, have, best = 0, 0, Counter(), None
    while right < len(pos) or best:
        if best and (right == len(pos) or pos[left] > pos[best[1]]):  # go on behind it
            yield int(pos[best[0]]), int(pos[best[1]]), best[2]
            left = right = best[1] + 1
            have, best = Counter(), None
            continue
        have[pair[right]] += 1
        while pos[right] - pos[left] >= template.width or have[pair[left]] > 1:
            have[pair[left]] -= 1
            if not have[pair[left]]:
                del have[pair[left]]
            left += 1
        if len(have) >= template.need and (best is None or (len(have), pos[left] - pos[right]) > (best[2], pos[best[0]] - pos[best[1]])):
            if best and best[0] < left:  # what lies before the better window
                yield int(pos[best[0]]), int(pos[best[1]]), best[2]
            best = left, right, len(have)
        right += 1


def windows(which: np.ndarray, document: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """Every place at which a template may be confirmed: its first and last word, the template's number and share. Words of different documents make no pair."""
    _, number, of = _tables()
    pair = number[which[:-1], which[1:]]
    place = np.flatnonzero((pair >= 0) & (document[:-1] == document[1:]))
    pair = pair[place]
    apart = place + document[place] * (1 << 32)  # no window spans two documents
    for k, t in enumerate(templates()):
        mine = np.flatnonzero(of[pair, k])
        pos = apart[mine]
        near = np.flatnonzero(pos[t.need - 1 :] - pos[: len(pos) - t.need + 1] < t.width) if len(pos) >= t.need else ()
        if not len(near):
            continue
        held = np.zeros(len(pos) + 1, np.int64)  # hits that lie in some such stretch, in runs
        np.add.at(held, near, 1)
        np.add.at(held, near + t.need, -1)
        held = np.flatnonzero(np.cumsum(held)[:-1] > 0)
        for run in np.split(held, np.flatnonzero((np.diff(held) > 1) | (np.diff(pos[held]) >= t.width)) + 1):
            shift = document[place[mine[run[0]]]] * (1 << 32)
            for a, b, n in _best_windows(pos[run], pair[mine[run]], t):
                yield int(a - shift), int(b - shift) + 1, k, n / len(t.pairs)


def find_all(column: pa.Array, model: Classifier | None = None) -> list[list[tuple[int, int, str, float, float]]]:
    """For each text its spans in code points with family, probability and share of the template, in order."""
    model = model or trained()
    raw, at, begin, end, which = cut(column)
    document = np.searchsorted(at, begin, side="right") - 1
    first = np.searchsorted(begin, at)  # each text's first word
    line = np.searchsorted(np.flatnonzero(raw == 10), begin)
    found: list[list[tuple]] = [[] for _ in range(len(column))]
    if len(which) < 2:
        return found
    order = templates()
    seen: dict[tuple[int, int], tuple[str, float, float]] = {}
    for a, b, k, share in windows(which, document):
        d = int(document[a])
        x, y = max(int(first[d]), a - CONTEXT), min(int(first[d + 1]), b + 1 + CONTEXT)
        x, y = x + int(np.count_nonzero(line[x:a] != line[a])), y - int(np.count_nonzero(line[b + 1 : y] != line[b]))
        if (x, y) not in seen:
            seen[x, y] = model.classify([raw[i : j + 1].tobytes().decode().lower() for i, j in zip(begin[x:y].tolist(), end[x:y].tolist(), strict=True)])
        family, p, _ = seen[x, y]
        if family == order[k].family:
            found[d].append((share, order[k].size, p, -a, a, b, family))
    for d, rows in enumerate(found):
        if not rows:
            continue
        kept: list[tuple] = []  # by place, and disjoint
        for share, _, p, _, a, b, family in sorted(rows, reverse=True):
            i = bisect_left(kept, (a,))
            if (i == 0 or kept[i - 1][1] < a) and (i == len(kept) or kept[i][0] > b):
                kept.insert(i, (a, b, family, p, share))
        bounds = np.array([(begin[a], end[b] + 1) for a, b, *_ in kept]).ravel()
        new = (raw[at[d] : at[d + 1]] & 0xC0) != 0x80  # bytes that begin a code point
        points = np.append(0, np.cumsum(new))[bounds - at[d]]
        found[d] = [(x, y, family, p, share) for x, y, (_, _, family, p, share) in zip(points[::2].tolist(), points[1::2].tolist(), kept, strict=True)]
    return found


def find(text: str, model: Classifier | None = None) -> list[tuple[int, int, str, float, float]]:
    """The spans of one text."""
    return find_all(pa.array([text], pa.string()), model)[0]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("contained", pa.float64())])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and licences: spans in code points with family, probability and share of the template."""
    rows = id_and_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = [[dict(zip(("start", "end", "family", "probability", "contained"), s, strict=True)) for s in spans] for spans in find_all(block.column(1), shared.value)]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(found, pa.list_(_SPAN))], ["doc_id", "licences"])

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, licences array<struct<start:long,end:long,family:string,probability:double,contained:double>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(documents(spark, sf_dir))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda s: s["family"]))), ",")
    return rows.select("doc_id", families.alias("families"), F.size("licences").cast("long").alias("n_spans"), F.array_max(F.transform("licences", lambda s: s["probability"])).alias("probability"))

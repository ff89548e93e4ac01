"""Licence scan: a trained classifier of passages, confirmed by comparison with templates.

A paragraph is a run of lines that hold words. Each of its lines and, if it has several, the paragraph
as a whole are read in overlapping passages of ``passage`` words, so that neither a wrapped notice
nor one among other lines is missed. Marks that begin comment lines are blanked out.
Sparse word 1- and 2-grams go through a multinomial logistic regression with a class for each
licence family and one for everything else. Its probabilities are calibrated on examples held out
of the fit, by a temperature and by a limit for the unknown class that at most ``false_share`` of
the corpus examples pass. The families that the model ranks first for a passage it takes for a licence
are its candidates; comparison with the templates, of every family, confirms them. A candidate counts where the passage shares enough word 3-grams with one of
its templates, unless another family's template agrees as well or better on the same words; so one
passage may declare several families, and words common to several decide for none, unless a passage
with more of the notice does. What the templates find but the model ranks lower does not count. A
passage that holds no word of a family that counts is reported as
unconfirmed, a line's passage only if none of its paragraph's is that holds it.

The examples are made from the templates (cut, with words dropped, with other text around them),
and, for the unknown class, taken from lines of a bounded sample of the corpus that share no
3-gram with a template. Scanning reads every text whole and needs no shuffle.

Defined cases: null and empty text hold no paragraph and no licence; a text of any length is
scanned whole; a family found more than once is listed once, families in alphabetical order; lines
are all those that hold words of a notice; ``n_paragraphs`` counts the lines that are not blank; repeated rows give repeated results; ids may be null; an empty table
gives an empty result, the model is then fitted on the templates alone; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import as_bytes
from branchledger.llm.hashing import chunks, mix, words

#: Notices by which licences are commonly declared.
TEMPLATES = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GNU Affero General Public License, version 3",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "This project is released under the Apache 2.0 license",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Released under CC0 1.0 Universal public domain dedication",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
        "Licensed under the Mozilla Public License 2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain",
    ],
}

UNKNOWN = "unknown"
#: Bytes that separate words besides white space; dots only at a word's end.
_MARKS = bytes.maketrans(b",;:()[]{}\"'<>!?", b" " * 15)
_DOT = re.compile(rb"\.(?=\s|$)")
#: What begins a line of a comment or a quotation.
_COMMENT = re.compile(rb"^[ \t]*(?:#+|//+|/?\*+/?|--+|>+|%+)(?=\s|$)", re.M)


@dataclass(frozen=True)
class Scan:
    passage: int = 48
    step: int = 24
    #: Share of the 3-grams of the shorter of passage and template that must be common to both.
    confirmed: float = 0.8
    #: Families that are candidates for a passage, by the model's probabilities.
    candidates: int = 5
    #: Documents to take corpus examples from, lines of each, and their longest.
    sample: int = 2000
    lines: int = 4
    longest: int = 2000
    #: Examples made of each template.
    made: int = 60
    false_share: float = 0.001
    penalty: float = 1e-3
    steps: int = 400


def plain(text: bytes) -> bytes:
    """Same length, with the marks that may stand beside a word or begin a line blanked out."""
    text = _COMMENT.sub(lambda m: b" " * len(m[0]), text)
    return _DOT.sub(b" ", text.translate(_MARKS))


def grams(words_: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words_[i : i + n]) for i in range(len(words_) - n + 1)}


def tokens(text: str) -> list[str]:
    return [w.decode("utf-8", "replace") for w in plain(text.encode()).lower().split()]


def _features(hashed: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of 1- and 2-grams and the index of the word each begins at."""
    pair = np.flatnonzero(unit[1:] == unit[:-1])
    both = mix(hashed[pair] * np.uint64(3) + mix(hashed[pair + 1]))
    return np.concatenate([hashed, both]), np.concatenate([np.arange(hashed.size), pair])


class Words(NamedTuple):
    """Of each word its hash, the number of its text and of its line there."""

    hashed: np.ndarray
    text: np.ndarray
    line: np.ndarray


@dataclass
class Model:
    scan: Scan
    families: list[str]
    grams: np.ndarray  # sorted hashes of the n-grams that have weights
    weights: np.ndarray  # n-grams x classes, the last class unknown
    bias: np.ndarray
    temperature: float
    limit: float

    def passages(self, texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts' words; of passages with any weighted n-gram first word, end, probabilities.

        Last, whether a passage is one of a paragraph of several lines.
        """
        text = [plain(x) for x in texts]
        hashed, of, start, _, data = words(text, lower=True)
        before = np.cumsum(data == 10)
        begins = np.cumsum([0] + [len(t) + 1 for t in text[:-1]])
        line = before[start] - np.append(0, before)[begins][of]
        apart, below = of[1:] != of[:-1], np.diff(line)
        own = np.cumsum(np.append(0, apart | (below != 0)))[: hashed.size]
        block = np.cumsum(np.append(0, apart | (below > 1)))[: hashed.size]
        # Paragraphs of a single line are read already.
        several = np.flatnonzero(own[np.searchsorted(block, block)] != own[np.searchsorted(block, block, side="right") - 1])
        lines, blocks = self._probabilities(hashed, own), self._probabilities(hashed[several], block[several])
        blocks = several[blocks[0]], several[blocks[1] - 1] + 1, blocks[2]
        return Words(hashed, of, line), *(np.concatenate(x) for x in zip(lines, blocks)), np.arange(lines[0].size + blocks[0].size) >= lines[0].size

    def _probabilities(self, hashed: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and class probabilities of the passages of each line."""
        if not hashed.size:
            return np.zeros(0, int), np.zeros(0, int), np.zeros((0, self.bias.size))
        first = np.searchsorted(line, line)  # the line's first word
        gram, at = _features(hashed, line)
        place = np.minimum(np.searchsorted(self.grams, gram), self.grams.size - 1)
        hit = self.grams[place] == gram
        place, at = place[hit], at[hit]
        # A word lies in up to two passages of its line.
        length = np.searchsorted(line, line, side="right") - first
        step, size = self.scan.step, self.scan.passage
        own = (at - first[at]) // step
        last = np.maximum(0, -(-(length[at] - size) // step))
        passages, rows = [], []
        for back in range(-(-size // step)):
            k = own - back
            valid = (k >= 0) & (k <= last) & (at - first[at] < k * step + size)
            passages.append(first[at][valid] + k[valid] * step)
            rows.append(place[valid])
        begin, row = np.concatenate(passages), np.concatenate(rows)
        begin, which = np.unique(begin, return_inverse=True)
        stop = np.minimum(first[begin] + length[begin], begin + size)
        total = np.zeros((begin.size, self.bias.size))
        once = np.unique(which * self.grams.size + row)  # presence, not count
        np.add.at(total, once // self.grams.size, self.weights[once % self.grams.size])
        n = 2 * (stop - begin) - 1
        p = (total / np.sqrt(n)[:, None] + self.bias) / self.temperature
        p = np.exp(p - p.max(axis=1, keepdims=True))
        return begin, stop, p / p.sum(axis=1, keepdims=True)

    def scan_texts(self, texts: list[bytes]) -> list[dict]:
        """Of each text: families, lines that confirm one, unconfirmed passages, best probability."""
        out = [{"families": set(), "lines": [], "unconfirmed": 0, "score": 0.0, "paragraphs": 0} for _ in texts]
        for row, text in zip(out, texts):
            row["paragraphs"] = sum(1 for x in text.split(b"\n") if x.strip())
        w, first, stop, p, whole = self.passages(texts)
        passed: dict[int, list[int]] = {}
        for i in np.flatnonzero(1 - p[:, -1] >= self.limit).tolist():
            passed.setdefault(int(w.text[first[i]]), []).append(i)
        for text, own in passed.items():
            row, sure = out[text], set()
            found = [m for i in own for m in matches(w.hashed[first[i] : stop[i]].tolist(), int(first[i]), i, self.scan.confirmed)]
            likely = {i: {self.families[k] for k in np.argsort(-p[i, :-1])[: self.scan.candidates].tolist()} for i in own}
            for m in decided(found):
                if m.family not in likely[m.passage]:
                    continue
                row["families"].add(m.family)
                row["score"] = max(row["score"], float(p[m.passage, self.families.index(m.family)]))
                sure |= m.words
            row["lines"] = np.unique(w.line[sorted(sure)]).tolist() if sure else []
            left = [i for i in own if sure.isdisjoint(range(first[i], stop[i]))]
            row["unconfirmed"] = len(left)
            blocks = [i for i in left if whole[i]]
            begins = first[blocks]
            for i in left if blocks else []:
                at = int(np.searchsorted(begins, first[i], side="right"))
                row["unconfirmed"] -= not whole[i] and any(stop[k] >= stop[i] for k in blocks[max(0, at - 2) : at])
        return out


class Match(NamedTuple):
    """A template found in a passage: its 3-grams there, their share, the words they cover."""

    family: str
    agree: tuple[int, float]
    words: frozenset[int]
    passage: int


#: Of each template the family and the number of its 3-grams; of each 3-gram its (template, place).
_NOTICES: list[tuple[str, int]] = []
_PLACES: dict[tuple[int, ...], list[tuple[int, int]]] = {}


def _index() -> None:
    for family, own in TEMPLATES.items():
        for template in own:
            hashed = words([plain(template.encode())], lower=True)[0].tolist()
            known: set = set()
            for k in range(len(hashed) - 2):
                gram = tuple(hashed[k : k + 3])
                if gram not in known:
                    known.add(gram)
                    _PLACES.setdefault(gram, []).append((len(_NOTICES), k))
            _NOTICES.append((family, len(known)))


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (place, place in the template) that rises in both, its steps short."""
    length, before = [1] * len(pairs), [-1] * len(pairs)
    for j, (x, k) in enumerate(pairs):
        for i in range(j - 1, -1, -1):
            if pairs[i][0] < x and pairs[i][1] < k and length[i] >= length[j]:
                length[j], before[j] = length[i] + 1, i
    j = max(range(len(pairs)), key=length.__getitem__)
    out = []
    while j >= 0:
        out.append(pairs[j])
        j = before[j]
    return out


def matches(hashed: list[int], first: int, passage: int, least: float) -> Iterator[Match]:
    """Every place of a passage where it shares enough 3-grams with a template, of any family.

    ``first`` is the number of the passage's first word.
    """
    if not _NOTICES:
        _index()
    own, found = set(), {}
    for x in range(len(hashed) - 2):
        gram = tuple(hashed[x : x + 3])
        own.add(gram)
        for template, k in _PLACES.get(gram, ()):
            found.setdefault(template, []).append((x, k))
    for template, pairs in found.items():
        family, size = _NOTICES[template]
        size = min(size, len(own))
        while (common := len({k for _, k in pairs})) >= least * size:
            run = _in_order(pairs)
            yield Match(family, (len(run), common / size), frozenset(first + x + d for x, _ in run for d in range(3)), passage)
            pairs = sorted(set(pairs).difference(run))
            if not pairs:
                break


def decided(found: list[Match]) -> list[Match]:
    """The matches that tell their family: no other family's agrees as well on all their words."""
    at: dict[int, list[Match]] = {}
    for m in found:
        for x in m.words:
            at.setdefault(x, []).append(m)
    return [m for m in found if not any(o.family != m.family and o.agree >= m.agree and o.words >= m.words for o in at[min(m.words)])]


def examples(s: Scan) -> list[tuple[str, str]]:
    """(text, family) made from the templates: whole, cut, with words dropped, with other words around."""
    rng = np.random.Generator(np.random.PCG64(5))
    out = []
    for family, own in TEMPLATES.items():
        for template in own:
            source = template.split()
            out.append((template, family))
            for _ in range(s.made):
                kept = [w for w in source if rng.random() > 0.08]
                if len(kept) > 8 and rng.random() < 0.4:
                    a = int(rng.integers(0, len(kept) // 3))
                    kept = kept[a : a + max(6, int(len(kept) * rng.uniform(0.5, 1)))]
                around = [f"x{rng.integers(1 << 30)}" for _ in range(int(rng.integers(0, 10)))]
                cut = int(rng.integers(0, len(around) + 1))
                out.append((" ".join([*around[:cut], *kept, *around[cut:]]), family))
    return out


def fit(corpus: list[str], s: Scan) -> Model:
    """A model from made examples and lines of the corpus."""
    families = sorted(TEMPLATES)
    known = {g for own in TEMPLATES.values() for t in own for g in grams(tokens(t), 3)}
    made = examples(s)
    others = [(t, UNKNOWN) for t in corpus if tokens(t) and not grams(tokens(t), 3) & known]
    # Words of templates in other orders are not a licence.
    rng = np.random.Generator(np.random.PCG64(6))
    pool = [w for own in TEMPLATES.values() for t in own for w in t.split()]
    others += [(" ".join(rng.choice(pool, int(rng.integers(3, 12)))), UNKNOWN) for _ in range(400)]
    both = made + others
    classes = np.array([families.index(c) if c != UNKNOWN else len(families) for _, c in both])
    held = np.arange(len(both)) % 4 == 3
    hashed, unit, _, _, _ = words([plain(t.encode().replace(b"\n", b" ")) for t, _ in both], lower=True)
    gram, at = _features(hashed, unit)
    notices = [plain(t.encode()) for own in TEMPLATES.values() for t in own]
    notice, line, _, _, _ = words(notices, lower=True)
    wanted = np.unique(_features(notice, line)[0])
    place = np.minimum(np.searchsorted(wanted, gram), wanted.size - 1)
    hit = wanted[place] == gram
    count = np.bincount(unit, minlength=len(both))
    x = np.zeros((len(both), wanted.size), np.float32)
    x[unit[at][hit], place[hit]] = 1.0
    x /= np.sqrt(np.maximum(1, 2 * count - 1))[:, None]
    y = np.eye(len(families) + 1, dtype=np.float32)[classes]
    w, b = np.zeros((wanted.size, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    weight = (1 / np.bincount(classes[~held], minlength=y.shape[1]).clip(1))[classes][~held].astype(np.float32)[:, None]
    weight /= weight.sum()
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for step in range(s.steps):  # accelerated gradient steps
        p = _softmax(x[~held] @ w + b)
        error = weight * (p - y[~held])
        speed_w = 0.9 * speed_w - 20 * (x[~held].T @ error + s.penalty / 100 * w)
        speed_b = 0.9 * speed_b - 2 * error.sum(axis=0)
        w, b = w + speed_w, b + speed_b
    logit = x[held] @ w + b
    temperature = min((2.0 ** (e / 2) for e in range(-4, 7)), key=lambda t: -np.log(np.maximum(1e-9, _softmax(logit / t)[np.arange(held.sum()), classes[held]])).mean())
    licence = 1 - _softmax((x @ w + b) / temperature)[classes == len(families), -1]
    limit = max(0.5, float(np.quantile(licence, 1 - s.false_share)))
    return Model(s, families, wanted, w.astype(float), b.astype(float), temperature, min(limit, 0.9))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def share(wanted: int, rows: int) -> float:
    """The part of ``rows`` that leaves about ``wanted``, as a double: no number of rows overflows."""
    return wanted / max(rows, 1)


def train(docs: DataFrame, s: Scan = Scan(), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model whose corpus examples come from a bounded sample of documents, chosen by hash."""
    lines = F.slice(F.filter(F.split(text_col, "\n"), lambda x: F.length(x).between(1, s.longest)), 1, s.lines)
    # A share that leaves about twice the sample, so that tasks send few rows, then the first by hash.
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(3)), F.lit(1 << 30)) / F.lit(1 << 30)
    few = docs.where(place < share(2 * s.sample, docs.count()))
    sample = few.select(place.alias("h"), lines.alias("lines")).orderBy("h", "lines").limit(s.sample)
    return fit([x for r in sample.collect() for x in r.lines or []], s)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_paragraphs, licences, licence_lines (from 0), n_unconfirmed, score.

    The score is the highest probability of a family in a passage that confirms it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(as_bytes(batch.column(1))):
                found = shared.value.scan_texts(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(part)),
                        pa.array([r["paragraphs"] for r in found], pa.int64()),
                        pa.array([sorted(r["families"]) for r in found], pa.list_(pa.string())),
                        pa.array([sorted(r["lines"]) for r in found], pa.list_(pa.int64())),
                        pa.array([r["unconfirmed"] for r in found], pa.int64()),
                        pa.array([r["score"] for r in found], pa.float64()),
                    ],
                    names=[id_col, "n_paragraphs", "licences", "licence_lines", "n_unconfirmed", "score"],
                )

    own = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {own}, n_paragraphs long, licences array<string>, licence_lines array<long>, n_unconfirmed long, score double"
    )

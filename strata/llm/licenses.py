"""License scans: winnowed fingerprints pick candidates, banded alignment reports spans.

The winnowed hashes of the templates' word runs (single words of short notices)
are a small inverted index.  A document's runs that are in it give diagonals of
a template; near diagonals are chained to one band, and a banded local
alignment of words in it reports how much of the template is there and where
in the text.  A span is named only if its names and numbers are those of the
template and no other template covers the same place better.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.license_texts import TEXTS

RUN = 2
#: Winnowing windows: a run for every so many words of a template, at most WINDOW runs.
WORDS_A_RUN = 12
WINDOW = 8
BAND = 6
LEAST_COVERAGE = 0.6
#: Text words that one alignment takes at once; longer bands are cut into overlapping pieces.
PIECE = 16_384
#: A span goes where another template covers so much of its place better.
COVERED = 0.9

#: Templates of fewer words are found by single words.
SHORT = 12
#: Words that, like the numbers, tell a licence from another.
NAMING = frozenset("mit apache gnu lesser affero library cc nc nd sa cc0 noncommercial sharealike noderivatives mozilla eclipse".split())

_WORD = re.compile(r"[a-z0-9]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)

# The notices that the test documents have, openings of licences, and published texts (TEXTS).
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."
    ),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
} | TEXTS


class WordIds(dict):
    """Word to 64-bit hash; forgets when it holds ``most`` words."""

    most = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def run_hashes(ids: np.ndarray, run: int = RUN) -> np.ndarray:
    """Hash of every run of ``run`` words."""
    n = max(0, len(ids) - run + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(run):
            h = (h ^ (h >> np.uint64(31))) * _MUL + ids[k : k + n]
        return (h ^ (h >> np.uint64(29))) * _MUL


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions whose hash is the least of some window of positions (all of a text shorter than a window: its least)."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    width = min(window, n)
    least = hashes[: n - width + 1].copy()
    for k in range(1, width):
        least = np.minimum(least, hashes[k : n - width + 1 + k])
    chosen = np.zeros(n, bool)
    for k in range(width):
        here = hashes[k : n - width + 1 + k] == least
        chosen[k : n - width + 1 + k] |= here
    return np.flatnonzero(chosen)


def window_of(m: int) -> int:
    """Winnowing window of a template of ``m`` words."""
    return min(WINDOW, 1 + m // WORDS_A_RUN)


def align(text: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[list[tuple[int, int]], int]:
    """Best local alignment within ``low <= text position - template position <= high``.

    Match 2, mismatch and gap -1.  Returns the matched (template, text)
    positions and the score; ties: the match that ends first in the template,
    then in the text.  A row of the band is one array step; memory is the
    template's words by the band's width.
    """
    m, n = len(template), len(text)
    low, high = max(low, 1 - m), min(high, n - 1)
    if m == 0 or low > high:
        return [], 0
    width = high - low + 1
    # text of the band, padded with -1, which is no word of a template
    padded = np.full(m + width - 1, -1, np.int64)
    first, end = max(0, low), min(n, low + m + width - 1)
    padded[first - low : end - low] = text[first:end]
    at = np.arange(width, dtype=np.int32)
    score, moves = np.zeros(width + 1, np.int32), np.zeros((m, width), np.int8)
    best, last = 0, (-1, -1)
    for i in range(m):
        both = score[:-1] + np.where(padded[i : i + width] == template[i], 2, -1).astype(np.int32)
        skip = score[1:] - 1  # a template word left out
        cell = np.maximum(both, skip)
        run = np.maximum.accumulate(cell + at) - at  # text words left out
        moves[i] = np.where(run <= 0, 0, np.where(run > cell, 3, np.where(skip > both, 2, 1)))
        score[:-1] = np.maximum(run, 0)
        top = int(score[:-1].max())
        if top > best:
            best, last = top, (i, int(score[:-1].argmax()))
    pairs = []
    i, b = last
    while i >= 0 and 0 <= b < width and moves[i, b]:
        move = moves[i, b]
        if move == 3:
            b -= 1
            continue
        if move == 1 and padded[i + b] == template[i]:
            pairs.append((i, i + b + low))
        i, b = i - 1, b + (move == 2)
    return pairs[::-1], best


class Scanner:
    def __init__(self, templates: dict[str, str], run: int = RUN, band: int = BAND):
        self.ids, self.run, self.band = WordIds(), run, band
        self.names = sorted(templates)
        self.words, self.named, self.naming = [], [], []
        #: Hash of a word run to (template, position): winnowed runs, single words of short notices.
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.single: dict[int, list[tuple[int, int]]] = {}
        for t, name in enumerate(self.names):
            words = _WORD.findall(templates[name].lower())
            ids = self.hashed(words)
            marks = [k for k, w in enumerate(words) if w in NAMING or w.isdigit()]
            self.words.append(ids)
            self.named.append(set(marks))
            self.naming.append({int(ids[k]) for k in marks if not words[k].isdigit()})
            if marks and len(words) < SHORT:
                # all of these words have to be found, so the first of them leads to every span
                k = min(marks, key=lambda k: (words[k].isdigit(), k))
                self.single.setdefault(int(ids[k]), []).append((t, k))
            elif len(words) < SHORT:
                for k, h in enumerate(ids.tolist()):
                    self.single.setdefault(h, []).append((t, k))
            else:
                hashes = run_hashes(ids, run)
                for k in winnowed(hashes, window_of(len(ids))).tolist():
                    self.runs.setdefault(int(hashes[k]), []).append((t, k))
        self.known = [np.array(sorted(x), np.uint64) for x in (self.runs, self.single)]
        self.vocabulary = np.unique(np.concatenate([*self.words, np.empty(0, np.uint64)]))
        #: Share of each template that a word of the vocabulary is.
        self.shares = np.zeros((len(self.names), len(self.vocabulary)))
        for t, ids in enumerate(self.words):
            np.add.at(self.shares[t], np.searchsorted(self.vocabulary, ids), 1 / max(1, len(ids)))
        #: The templates' words by their places in the vocabulary.
        self.local = [np.searchsorted(self.vocabulary, ids) for ids in self.words]

    def hashed(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, words), np.uint64, len(words))

    def localized(self, ids: np.ndarray) -> np.ndarray:
        """Words of a text by their places in the templates' vocabulary, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, ids), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == ids, at, -1)

    def candidates(self, ids: np.ndarray, local: np.ndarray, least: float) -> dict[int, np.ndarray]:
        """``{template: (text position, diagonal) of its fingerprints in the text}``, of templates whose words are there."""
        there = np.zeros(len(self.vocabulary))
        there[local[local >= 0]] = 1
        enough = set(np.flatnonzero(self.shares @ there >= least - 1e-9).tolist())
        found: dict[int, list[tuple[int, int]]] = {}
        if not enough:
            return {}
        for index, known, hashes in zip((self.runs, self.single), self.known, (run_hashes(ids, self.run), ids)):
            if not len(known) or not len(hashes):
                continue
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for p in np.flatnonzero(known[at] == hashes).tolist():
                for t, q in index[int(hashes[p])]:
                    if t in enough:
                        found.setdefault(t, []).append((p, p - q))
        return {t: np.array(seeds) for t, seeds in found.items()}

    def bands(self, t: int, seeds: np.ndarray) -> list[tuple[int, int]]:
        """Diagonals in reach of the seeds, chained where they meet, in pieces of ``PIECE`` that overlap by a span."""
        reach, m = self.reach(t), len(self.words[t])
        diagonals = np.unique(seeds[:, 1])
        cuts = np.flatnonzero(np.diff(diagonals) > 2 * reach) + 1
        pieces = []
        for part in np.split(diagonals, cuts):
            low, high = int(part[0]) - reach, int(part[-1]) + reach
            while high - low >= PIECE + 2 * (m + reach):
                pieces.append((low, low + PIECE + m + 2 * reach))
                low += PIECE
            pieces.append((low, high))
        return pieces

    def possible(self, t: int, text: np.ndarray, least: float) -> bool:
        """Whether any stretch as long as a span can be has enough of the template's words."""
        m = len(self.words[t])
        sums = np.concatenate([[0], np.cumsum(np.isin(text, self.local[t]))])
        width = min(len(text), m + self.reach(t))
        return bool((sums[width:] - sums[: len(sums) - width]).max() >= least * m - 1e-9)

    def aligned(self, t: int, local: np.ndarray, seeds: np.ndarray, least: float) -> list[list[tuple[int, int]]]:
        """Alignments of a template that cover ``least`` of it, none over another of the same band.

        What lies before and behind an alignment is searched again while its
        score can be one of a covering span: enough matches, less a loss for
        every other word of the template and for each word in between.
        """
        m, reach, out = len(self.words[t]), self.reach(t), []
        lowest = 2 * least * m - (1 - least) * m - reach
        rest = [(0, len(local), seeds)]
        while rest:
            begin, end, inside = rest.pop()
            for low, high in self.bands(t, inside):
                first, last = max(begin, low), min(end, high + m)
                text = local[first:last]
                if not self.possible(t, text, least):
                    continue
                pairs, score = align(text, self.local[t], low - first, high - first)
                if not pairs or score < lowest:
                    continue
                pairs = [(i, j + first) for i, j in pairs]
                if len(pairs) >= least * m - 1e-9:
                    out.append(pairs)
                for a, b in ((first, pairs[0][1]), (pairs[-1][1] + 1, last)):
                    within = inside[(inside[:, 0] >= a) & (inside[:, 0] < b)]
                    if len(within):
                        rest.append((a, b, within))
        return out

    def named_by(self, t: int, words: list[str], pairs: list[tuple[int, int]], first: int, end: int) -> bool:
        """Whether a span has the names and numbers of its template, and no others.

        A short notice needs all of its own.  A longer text needs each name
        once, and no other name or number may stand in the span or where the
        template goes on.
        """
        m = len(self.words[t])
        if m < SHORT and self.named[t] - {i for i, _ in pairs}:
            return False
        if not self.named[t]:
            return True
        if self.naming[t] - {int(self.words[t][i]) for i, _ in pairs}:
            return False
        met = {j for _, j in pairs}
        around = range(max(0, first - pairs[0][0]), min(len(words), end + m - 1 - pairs[-1][0]))
        return not any(j not in met and (words[j] in NAMING or words[j].isdigit()) for j in around)

    def reach(self, t: int) -> int:
        """Diagonals to both sides that are aligned: all that the missing words of a template can shift."""
        return self.band + int((1 - LEAST_COVERAGE) * len(self.words[t]))

    def scan(self, text: str, least: float) -> list[tuple[str, float, int, int, int]]:
        """``(template, coverage, matched, first character, end)``, best first; spans of one template do not overlap."""
        lowered = text.lower()
        words = _WORD.findall(lowered)
        ids = self.hashed(words)
        local = self.localized(ids)
        candidates = self.candidates(ids, local, least)
        if not candidates:
            return []
        spans = [m.span() for m in _WORD.finditer(lowered)]
        found = []
        for t, seeds in sorted(candidates.items()):
            for pairs in self.aligned(t, local, seeds, least):
                first, end = pairs[0][1], pairs[-1][1] + 1
                if self.named_by(t, words, pairs, first, end):
                    found.append((self.names[t], len(pairs) / len(self.words[t]), len(pairs), spans[first][0], spans[end - 1][1]))
        found.sort(key=lambda f: (-f[1], -f[2], f[0], f[3]))
        kept: list = []
        for f in found:
            for k in kept:
                common = min(f[4], k[4]) - max(f[3], k[3])
                if common > 0 and (k[0] == f[0] or (k[1] > f[1] and common >= COVERED * (f[4] - f[3]))):
                    break
            else:
                kept.append(f)
        return kept


_SPAN = "struct<license:string,coverage:double,matched:int,first:int,end:int>"
_SPAN_ARROW = pa.struct(
    [("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int32()), ("first", pa.int32()), ("end", pa.int32())]
)


def license_spans(
    docs: DataFrame,
    *,
    templates: dict[str, str] | None = None,
    least_coverage: float = LEAST_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, license, coverage, n_spans, spans)`` for every row, without a shuffle.

    ``spans`` lists every template of which ``least_coverage`` or more is
    found, with no other licence's name or number in the span, but for spans
    of which another template covers ``COVERED`` with a larger coverage.  A
    template of ``SHORT`` or more words needs ``RUN + window_of(words) - 1``
    equal words in a row (3 for 12 words, 9 from 84 words on), which always
    hold a winnowed fingerprint; a shorter one needs all of its own names
    and numbers, or any word where it has none.  Text words between the
    template's are bridged up to ``BAND`` and four tenths of the template.  Spans are in characters (of the
    ASCII words of the lower-cased text); ``license`` is the best one (larger
    coverage, more words, name), null when there is none.  Null and empty texts have none.  Null ids and
    repeated rows pass row by row; empty table: empty result.  The templates
    are a parameter and go to every task, so they must be few.
    """
    chosen = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            found = [scanner.scan(t or "", least_coverage) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0][0] if f else None for f in found], pa.string()),
                    pa.array([f[0][1] if f else 0.0 for f in found], pa.float64()),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array([[dict(zip(("license", "coverage", "matched", "first", "end"), s)) for s in f] for f in found], pa.list_(_SPAN_ARROW)),
                ],
                ["doc_id", "license", "coverage", "n_spans", "spans"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id long, license string, coverage double, n_spans int, spans array<{_SPAN}>"
    )

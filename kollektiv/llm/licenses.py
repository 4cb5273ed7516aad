"""License scans by patience alignment.

A license template and a stretch of a document are aligned on the words that
are unique in both: the longest increasing subsequence of their positions
anchors the alignment, and the gaps between anchors are aligned the same way,
until no word is unique on both sides (equal words at the edges of a gap are
matched first).  Where the words of a gap only repeat, as in a notice that stands
twice, its longest common subsequence that ends first is matched.  Coverage is the share of the template's words that the
alignment matches.

A template is only aligned with stretches that can reach the coverage asked
for: every window of twice the template's length is counted for words that the
template has (by hash, for the whole batch at once), and windows with too few
are skipped, which loses nothing whose matched words lie within one and a half
template lengths.  Neighbouring windows join into one stretch, and a stretch
that does not give the whole template is aligned window by window too.

A word is a run of letters, digits and bytes over 127, A-Z lower-cased.

Defined cases: null and empty texts have no licenses; a template without words
is found nowhere; of stretches of a text with equal coverage the first counts;
repeated rows are scanned each; null ids are carried; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kollektiv.llm.common import byte_slices
from kollektiv.llm.toxicity import letter_words

PERCENT = 80

#: Notices looked for by default: (license, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
)


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience piles)."""
    tops, at, back = [], [], []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[p], at[p] = v, i
        back.append(at[p - 1] if p else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def common(template: list, text: list) -> list[tuple[int, int]]:
    """A longest common subsequence, of those that end first in the text the one
    whose words stand last; rows of bits, one of a text position."""
    m = len(template)
    at: dict = {}
    for i, w in enumerate(template):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << m) - 1
    row, rows, best, end = full, [full], 0, 0
    for j, w in enumerate(text, 1):
        x = row & at.get(w, 0)
        row = ((row + x) | (row - x)) & full
        rows.append(row)
        n = m - row.bit_count()
        if n > best:
            best, end = n, j
    # a clear bit i of a row: the subsequence grows with template word i
    out, i, j = [], m, end
    length = lambda i, j: i - (rows[j] & ((1 << i) - 1)).bit_count()
    while best:
        while length(i - 1, j) == best:
            i -= 1
        while template[i - 1] != text[j - 1] or length(i - 1, j - 1) != best - 1:
            j -= 1
        out.append((i - 1, j - 1))
        i, j, best = i - 1, j - 1, best - 1
    return out[::-1]


def align(template: list, text: list, repeats: bool = False) -> list[tuple[int, int]]:
    """Matched (template, text) positions, ascending in both.  With ``repeats``,
    gaps of words that only repeat are matched by ``common``."""
    out, todo = [], [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        left, right = Counter(template[a:b]), Counter(text[c:d])
        place = {w: i for i, w in enumerate(text[c:d], c) if right[w] == 1}
        both = [(i, place[w]) for i, w in enumerate(template[a:b], a) if left[w] == 1 and w in place]
        anchors = [both[i] for i in increasing([p for _, p in both])]
        if not anchors:
            if repeats:
                out += [(a + i, c + j) for i, j in common(template[a:b], text[c:d])]
            continue
        out += anchors
        for (p, q), (r, s) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)], strict=True):
            todo.append((p + 1, r, q + 1, s))
    return sorted(out)


def _windows(has: np.ndarray, span: int, need: int) -> list[tuple[int, int]]:
    """Windows of ``span`` positions, every half span, with at least ``need``
    marked ones."""
    sums = np.concatenate([[0], np.cumsum(has)])
    half = max(1, span // 2)
    lo = np.arange(0, max(1, len(has) - half), half)
    hi = np.minimum(lo + span, len(has))
    ok = sums[hi] - sums[lo] >= need
    return list(zip(lo[ok].tolist(), hi[ok].tolist(), strict=True))


def _stretches(windows: list[tuple[int, int]], span: int) -> list[list[tuple[int, int]]]:
    """Neighbouring windows that join into stretches of at most four spans."""
    out: list[list[tuple[int, int]]] = []
    for a, b in windows:
        if out and a <= out[-1][-1][1] and b - out[-1][0][0] <= 4 * span:
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
    return out


class Scanner:
    def __init__(self, templates, percent: int = PERCENT):
        self.percent, self.items = percent, []
        for name, text in templates:
            w = letter_words(pa.array([text]))
            if len(w):
                self.items.append((name, w.hash.tolist(), np.unique(w.hash)))
        every = np.unique(np.concatenate([u for _, _, u in self.items])) if self.items else np.zeros(0, np.uint64)
        self.every = every
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(every % np.uint64(1 << 20)).astype(np.int64)] = True

    def scan(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text, item, matched words, first word, one past the last) of every
        template that a text covers far enough: its best stretch."""
        w = letter_words(column)
        out = []
        if not len(w) or not self.items:
            return out
        maybe = self.filter[(w.hash % np.uint64(1 << 20)).astype(np.int64)]
        text = w.text_of()
        counts = np.bincount(text[maybe], minlength=len(column))
        for t in np.flatnonzero(counts):
            a, b = w.off[t], w.off[t + 1]
            h, may = w.hash[a:b], maybe[a:b]
            for k, (_, words, own) in enumerate(self.items):
                need = -(-self.percent * len(words) // 100)
                if counts[t] < need:
                    continue
                has = np.zeros(len(h), bool)
                has[may] = np.isin(h[may], own)
                best, times = None, Counter(words)
                for windows in _stretches(_windows(has, 2 * len(words), need), 2 * len(words)):
                    for lo, hi in [(windows[0][0], windows[-1][1]), *windows]:
                        there = h[lo:hi][has[lo:hi]].tolist()
                        # no alignment has more than the words that both have
                        if (times & Counter(there)).total() < max(need, best[2] + 1 if best else 0):
                            continue
                        # words that only repeat are matched within one window
                        got = align(words, h[lo:hi].tolist(), hi - lo <= 2 * len(words))
                        if len(got) >= need and (best is None or len(got) > best[2]):
                            best = (int(t), k, len(got), lo + got[0][1], lo + got[-1][1] + 1)
                if best:
                    out.append(best)
        return out


def licenses(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """doc_id, license, template (its number), n_words, n_matched, coverage,
    first_word, last_word: templates that a document covers for ``percent`` %."""
    items = tuple(templates)

    def run(batches):
        scanner = Scanner(items, percent)
        for b in batches:
            for s in byte_slices(b, "text"):
                got = scanner.scan(s["text"])
                if got:
                    size = [len(scanner.items[k][1]) for _, k, *_ in got]
                    yield pa.RecordBatch.from_arrays(
                        [s["doc_id"].take(pa.array([t for t, *_ in got])), pa.array([scanner.items[k][0] for _, k, *_ in got]),
                         pa.array([k for _, k, *_ in got], pa.int32()), pa.array(size, pa.int64()),
                         pa.array([m for _, _, m, _, _ in got], pa.int64()), pa.array([g[2] / n for g, n in zip(got, size, strict=True)]),
                         pa.array([int(g[3]) for g in got], pa.int64()), pa.array([int(g[4]) for g in got], pa.int64())],
                        ["doc_id", "license", "template", "n_words", "n_matched", "coverage", "first_word", "last_word"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, license string, template int, n_words long, n_matched long, coverage double, first_word long, last_word long")

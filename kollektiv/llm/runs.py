"""Runs: maximal stretches of words that repeat with a period.

A run is a stretch of consecutive words of one text that has a smallest period
``q``, holds it at least twice and at least ``MIN_WORDS`` words, and that no
neighbouring word continues.

**Maximal pairs.**  Two occurrences of a word sequence are a maximal pair when
the words before them differ and the words after them differ.  A run of period
``q`` is the maximal pair of its start and the place ``q`` words later, whose
common sequence has at least ``q`` words; the run reaches from the first
occurrence to the end of the second, so nothing has to be extended.  The place
``q`` words later is also the next occurrence of that sequence: one in between
would give the run a smaller period.  So runs are exactly the maximal pairs of
*neighbouring* occurrences that are no farther apart than they are long.

**Enumeration.**  The texts of a slice that repeat six words somewhere (a run of
twelve words has such words) get a suffix array by prefix doubling and the
lengths that neighbouring suffixes share.  The tree of intervals of shared
lengths is walked from the bottom.  An interval holds its occurrences in text
order with the class of each, the word on its left; a child is merged into its
parent from the smaller side, and the neighbours that a merge makes have exactly
the parent's length in common.  Neighbours of one class continue to the left and
are passed over.  Words are numbered by their bytes (a dictionary of the words
of those texts), not by hashes; hashes only find the texts worth looking at.

Null and empty texts have no runs.  Rows are independent of each other: repeated
ids, null ids and extra columns change nothing.  Each text is worked on whole,
in one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm.common import WORD, arrow_map, byte_slices
from kollektiv.llm.words import Words, grams, mix

#: Least words of a run; half of them are shared by its two first occurrences.
MIN_WORDS = 12


def suffix_array(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, length shared with the one before) of a sequence of
    numbers whose last one stands nowhere else.  Ranks of 1, 2, 4, ... numbers
    are kept, so shared lengths are read off them from the longest down."""
    n = len(first)
    _, rank = np.unique(first, return_inverse=True)
    ranks, span = [rank.astype(np.int32)], 1
    while int(rank.max()) + 1 < n:
        ahead = np.zeros(n, np.int64)
        ahead[:n - span] = rank[span:] + 1
        _, rank = np.unique(rank * np.int64(n + 1) + ahead, return_inverse=True)
        ranks.append(rank.astype(np.int32))
        span *= 2
    order = np.argsort(rank)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        shared[1:][same] += 1 << k
        a, b = a + (same << k), b + (same << k)
    return order, shared


def maximal_pairs(order: list[int], shared: list[int], left: list[int], least: int):
    """(position, distance, length) of neighbouring occurrences of other left
    words that are at most ``length`` apart.  ``order`` and ``shared`` are a
    stretch of the suffix array in which neighbours share ``least`` or more."""
    found: list[tuple[int, int, int]] = []

    def merge(into: list[int], child: list[int], length: int) -> list[int]:
        if len(into) < len(child):
            into, child = child, into
        if len(child) * 8 > len(into) and len(child) > 64:
            new = set(child)
            into = sorted(into + child)
            pairs = [(x, y) for x, y in zip(into, into[1:], strict=False) if (x in new) != (y in new)]
        else:
            pairs = []
            for p in child:
                i = bisect_left(into, p)
                if i:
                    pairs.append((into[i - 1], p))
                if i < len(into):
                    pairs.append((p, into[i]))
            for p in child:
                insort(into, p)
        for x, y in pairs:
            # a stretch of one class continues to the left: no start of a run
            if y - x <= length and left[x] != left[y]:
                found.append((x, y - x, length))
        return into

    stack: list[tuple[int, list[int]]] = []
    for i in range(1, len(order) + 1):
        length, child = shared[i] if i < len(order) else -1, [order[i - 1]]
        while stack and stack[-1][0] > length:
            above, members = stack.pop()
            child = merge(members, child, above)
        if stack and stack[-1][0] == length:
            stack[-1] = (length, merge(stack[-1][1], child, length))
        elif length >= least:
            stack.append((length, child))
    return found


def runs_of_texts(texts: pa.Array) -> list[tuple[np.ndarray, Words]]:
    """Runs of each text, (start, length, period) by start, then period; and
    the words of all."""
    w = Words(texts)
    counts, half = w.counts, MIN_WORDS // 2
    n = len(counts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    text = w.text_of()
    g = grams(w.hash, half)
    if len(g):
        inside = np.arange(len(g)) + half <= w.off[text[:len(g)] + 1]
        with np.errstate(over="ignore"):
            keys = mix(g[inside] ^ (text[:len(g)][inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(keys)
        again = np.zeros(len(keys), bool)
        again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
        chosen = np.unique(text[:len(g)][inside][again])
        if len(chosen):
            _collect(w, chosen, counts, half, found)
    return [np.array(sorted(x), np.int64).reshape(-1, 3) for x in found], w


def _collect(w: Words, chosen: np.ndarray, counts: np.ndarray, half: int, found: list) -> None:
    """Adds the runs of the chosen texts.  Their words are numbered text by text,
    and a number that stands nowhere else follows each text, so that no sequence
    belongs to two texts."""
    at = np.concatenate([np.arange(w.off[t], w.off[t + 1]) for t in chosen])
    words = pa.array([w.word(i) for i in at], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    kinds, sizes = int(words.max()) + 1, counts[chosen]
    owner = np.repeat(np.arange(len(chosen)), sizes)
    first = np.empty(len(at) + len(chosen), np.int64)
    place = np.arange(len(at)) + owner
    first[place] = words + owner * kinds
    ends = np.cumsum(sizes + 1) - 1
    first[ends] = len(chosen) * kinds + np.arange(len(chosen))
    left = [-1, *first[:-1].tolist()]        # a text's first word has a class of its own
    order, shared = suffix_array(first)
    linked = shared >= half
    begins = np.flatnonzero(linked & ~np.concatenate([[False], linked[:-1]])) - 1
    stops = np.flatnonzero(linked & ~np.concatenate([linked[1:], [False]])) + 1
    text_at = np.repeat(np.arange(len(chosen)), sizes + 1)
    starts = ends - sizes
    for a, b in zip(begins.tolist(), stops.tolist(), strict=True):
        if np.diff(np.sort(order[a:b])).min() > shared[a + 1:b].max():
            continue                          # all too far apart: the usual case
        best: dict[tuple[int, int], int] = {}
        for x, q, length in maximal_pairs(order[a:b].tolist(), shared[a:b].tolist(), left, half):
            if q + length >= MIN_WORDS:
                # neighbours of an unfinished interval may still get an occurrence in between
                best[x, q + length] = min(q, best.get((x, q + length), q))
        for (x, length), q in best.items():
            t = int(text_at[x])
            found[int(chosen[t])].append((x - int(starts[t]), length, q))


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words are in no run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed): all runs of a text by start, then period, and the
    text without the words that a run repeats, one space between words."""
    kind = docs.select(id_col).schema[0]

    def find(batch: pa.RecordBatch):
        for part in byte_slices(batch, "__text"):
            runs, w = runs_of_texts(part.column("__text"))
            collapsed = []
            for t, found in enumerate(runs):
                a, b = int(w.off[t]), int(w.off[t + 1])
                if len(found):
                    keep = np.flatnonzero(kept_words(b - a, found)) + a
                    collapsed.append(b" ".join(map(w.word, keep.tolist())))
                else:
                    collapsed.append(b" ".join(w.list(t)))
            off = np.concatenate([[0], np.cumsum([len(x) for x in runs])]).astype(np.int32)
            flat = np.concatenate(runs)
            items = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part.column("__id"), pa.ListArray.from_arrays(pa.array(off), items), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["__id", "runs", "collapsed"])

    return arrow_map(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), find,
                     f"__id {kind.dataType.simpleString()}, runs {RUNS}, collapsed string").withColumnRenamed("__id", id_col)


def plant(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``; where crc32(doc_id as text) ends in 0, the
    text's words have a period from some word on and one space between them: with
    g = crc32 // 10 and n words, word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + (n - a) // (3 + g % 8).  A null doc_id and a text without words plant
    nothing."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(F.pmod(crc, F.lit(10)) == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    rows = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), words.alias("words"))
    n, g = F.size("words").cast("long"), F.col("g")
    rows = rows.withColumn("n", n).withColumn("a", F.pmod(g, F.greatest(n, F.lit(1))))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.pmod(g, F.lit(8)))))
    changed = F.expr("array_join(slice(concat(slice(words, 1, int(a)), flatten(array_repeat("
                     "slice(words, int(a) + 1, int(p)), int(ceil((n - a) / p))))), 1, int(n)), ' ')")
    return rows.select("doc_id", F.when(F.col("words").isNotNull() & (F.col("n") > 0), changed)
                       .otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """What ``periodic_runs`` found, as one run and digests of all."""
    best = F.reduce("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda have, r: F.when(
        have.isNull() | (r["length"] > have["length"]), r).otherwise(have))   # by start, then period: the first stays
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

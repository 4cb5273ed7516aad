"""Quality by a generalised additive model with pairwise interactions.

Every text is described by some twenty numbers (shares of kinds of characters,
words that repeat, lines that repeat, lengths).  Each number is cut into bins
at quantiles, and the model is one lookup table per number plus one per chosen
pair of numbers; a score is the logistic of their sum.

Training is cyclic boosting: round after round, every number in turn gets a
shallow tree over its bins, fitted to the current residuals and added to its
table with a small rate.  Then the pairs whose coarse grids explain most of
what is left get trees of two levels in the same way.  Rounds stop when a
validation part no longer improves.

It is fitted on a bounded sample of the labelled rows (``MOST_LABELLED`` of
each mark, by a hash of the id); only their numbers reach the driver.  Scoring
adds table rows by bin, batch by batch.

Defined cases: null text is empty; texts without words have all numbers 0 and
are scored like any other; null ids are never labelled; label rows with null
mark are ignored; the largest mark of a document counts; with one mark only, or
none, every score is that mark's (0.5 without any); other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm import words as W
from kollektiv.llm.common import arrow_map, byte_slices
from kollektiv.llm.toxicity import held_out, marks, sample_marks

MOST_LABELLED = 10_000
BINS, COARSE = 48, 8
RATE, ROUNDS, PATIENCE = 0.1, 400, 25
PAIRS, PAIR_ROUNDS = 8, 150
#: Rows that a leaf needs.
LEAF = 8

NAMES = ("words", "bytes", "word_bytes", "upper", "digits", "marks", "bangs", "bars", "stops", "lines", "distinct", "top_word",
         "same_as_before", "distinct_lines", "beyond_ascii", "short_words", "longest", "symbols_in_words", "capital_starts",
         "distinct_pairs")

_KINDS = {"upper": range(65, 91), "digits": range(48, 58), "marks": [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,!|"],
          "bangs": [33], "bars": [124], "stops": [44, 46], "lines": [10], "beyond_ascii": range(128, 256)}
_LINE = np.ones(256, bool)
_LINE[10] = False


def _per_text(sums: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(sums)])
    return c[off[1:]] - c[off[:-1]]


def features(column: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` numbers for each text."""
    w, lines = W.Words(column), W.Words(column, word_bytes=_LINE)
    n, size = w.counts, np.diff(w.text_off)
    words, chars = np.maximum(n, 1), np.maximum(size, 1)
    out = {"words": np.log1p(n), "bytes": np.log1p(size)}
    for name, codes in _KINDS.items():
        kind = np.zeros(256, np.int64)
        kind[list(codes)] = 1
        out[name] = _per_text(kind[w.data], w.text_off) / chars
    length = w.end - w.start
    out["word_bytes"] = _per_text(length, w.off) / words
    out["short_words"] = _per_text(length <= 3, w.off) / words
    first = w.data[w.start] if len(w) else np.zeros(0, np.uint8)
    out["capital_starts"] = _per_text((first >= 65) & (first <= 90), w.off) / words
    odd = np.zeros(256, bool)
    odd[[ord(c) for c in "%&$#*!|@^~<>{}[]\\/=+_"]] = True
    last = w.data[w.end - 1] if len(w) else np.zeros(0, np.uint8)
    out["symbols_in_words"] = _per_text(odd[last], w.off) / words
    same = np.zeros(len(w), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    same[w.off[:-1][n > 0]] = False
    out["same_as_before"] = _per_text(same, w.off) / words
    pairs = W.join2(np.concatenate([[np.uint64(0)], w.hash[:-1]]), w.hash) if len(w) else w.hash
    rest = {k: np.zeros(len(n)) for k in ("distinct", "top_word", "distinct_lines", "longest", "distinct_pairs")}
    for t in np.flatnonzero(n):
        a, b = w.off[t], w.off[t + 1]
        h = np.sort(w.hash[a:b])
        new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        rest["distinct"][t] = len(new) / (b - a)
        rest["top_word"][t] = np.diff(np.append(new, b - a)).max() / (b - a)
        rest["longest"][t] = np.log(length[a:b].max())
        p = np.sort(pairs[a:b])
        rest["distinct_pairs"][t] = (1 + np.count_nonzero(p[1:] != p[:-1])) / (b - a)
        x = np.sort(lines.hash[lines.off[t]:lines.off[t + 1]])
        rest["distinct_lines"][t] = (1 + np.count_nonzero(x[1:] != x[:-1])) / len(x)
    out |= rest
    return np.column_stack([out[k] for k in NAMES]).astype(np.float64)


# ---- the model ----------------------------------------------------------------

def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow regression tree over ordered bins: Newton step of each leaf."""
    out = np.zeros(len(g))

    def grow(lo: int, hi: int, left: int) -> None:
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        tg, th = cg[-1], ch[-1]
        if left and hi - lo > 1:
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((ch[:-1] >= LEAF * 0.05) & (th - ch[:-1] >= LEAF * 0.05),
                                cg[:-1] ** 2 / (ch[:-1] + 1) + (tg - cg[:-1]) ** 2 / (th - ch[:-1] + 1) - tg ** 2 / (th + 1), -1.0)
            best = int(np.argmax(gain))
            if gain[best] > 1e-9:
                grow(lo, lo + best + 1, left - 1)
                grow(lo + best + 1, hi, left - 1)
                return
        out[lo:hi] = tg / (th + 1)
    grow(0, len(g), depth)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cross cut of a grid (one cut in each direction): steps, gain."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best, cells = 0.0, None
    parts = lambda c, i, j: np.array([[c[i, j], c[i, -1] - c[i, j]], [c[-1, j] - c[i, j], c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j]]])
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            pg, ph = parts(cg, i, j), parts(ch, i, j)
            gain = (pg ** 2 / (ph + 1)).sum()
            if gain > best:
                best, cells = gain, (i, j, pg / (ph + 1))
    out = np.zeros_like(g)
    if cells:
        i, j, v = cells
        out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = v[0, 0], v[0, 1], v[1, 0], v[1, 1]
    return out, best


@dataclass
class Model:
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)])

    def raw(self, b: np.ndarray) -> np.ndarray:
        z = np.full(len(b), self.base)
        for i, t in enumerate(self.tables):
            z += t[b[:, i]]
        for i, j, t in self.pairs:
            z += t[self._coarse(b, i), self._coarse(b, j)]
        return z

    def _coarse(self, b: np.ndarray, i: int) -> np.ndarray:
        return b[:, i] * COARSE // (len(self.cuts[i]) + 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(self.bins(x)) if self.cuts else np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Cyclic boosting on rows ``x`` with marks ``y`` (both present)."""
    part = np.arange(len(y)) % 5 == 0                        # validation rows
    m = Model(float(np.log(np.average(y, weights=weight) / (1 - np.average(y, weights=weight)))))
    m.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    b = m.bins(x)
    fitted, z = ~part, np.full(len(y), m.base)

    def loss():
        s = np.where(y[part] == 1, z[part], -z[part])
        return np.average(np.logaddexp(0, -s), weights=weight[part])

    def steps():
        p = 1 / (1 + np.exp(-z[fitted]))
        return weight[fitted] * (y[fitted] - p), weight[fitted] * p * (1 - p)

    def boost(rounds, turn, state):
        best, kept, since = loss(), [t.copy() for t in state], 0
        for _ in range(rounds):
            turn()
            now = loss()
            if now < best - 1e-6:
                best, kept, since = now, [t.copy() for t in state], 0
            else:
                since += 1
                if since >= PATIENCE:
                    break
        for t, k in zip(state, kept, strict=True):
            t[...] = k

    def singles():
        for i, t in enumerate(m.tables):
            g, h = steps()
            at = b[fitted, i]
            step = RATE * _tree(np.bincount(at, g, len(t)), np.bincount(at, h, len(t)))
            t += step
            z[:] += step[b[:, i]]
    boost(ROUNDS, singles, m.tables)
    z[:] = m.raw(b)
    grid = [m._coarse(b, i) for i in range(len(m.cuts))]

    def sums(i, j):
        g, h = steps()
        at = grid[i][fitted] * COARSE + grid[j][fitted]
        return np.bincount(at, g, COARSE ** 2).reshape(COARSE, COARSE), np.bincount(at, h, COARSE ** 2).reshape(COARSE, COARSE)
    gains = sorted(((_pair_tree(*sums(i, j))[1], i, j) for i in range(len(m.cuts)) for j in range(i)), reverse=True)
    m.pairs = [(i, j, np.zeros((COARSE, COARSE))) for _, i, j in gains[:PAIRS]]

    def pairs():
        for i, j, t in m.pairs:
            step = RATE * _pair_tree(*sums(i, j))[0]
            t += step
            z[:] += step[grid[i], grid[j]]
    boost(PAIR_ROUNDS, pairs, [t for _, _, t in m.pairs])
    return m


# ---- Spark --------------------------------------------------------------------

def _described(docs: DataFrame) -> DataFrame:
    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            x = features(s["text"])
            yield pa.RecordBatch.from_arrays([s["doc_id"], pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])
    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, x array<double>")


def train(docs: DataFrame, known: DataFrame, most: int = MOST_LABELLED) -> Model:
    """``docs``: doc_id, text.  ``known``: doc_id, mark (0 or 1)."""
    marked, totals = sample_marks(known, most)
    if len(totals) < 2:
        return Model(0.0 if not totals else 30.0 if 1 in totals else -30.0)
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i in marked], "doc_id long")       # bounded by the sample
    rows = _described(docs.join(F.broadcast(wanted), "doc_id", "left_semi")).orderBy(F.xxhash64("doc_id")).collect()
    x = np.array([r["x"] for r in rows]).reshape(-1, len(NAMES))
    y = np.array([marked[r["doc_id"]] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(0.0 if not len(y) else 30.0 if y[0] else -30.0)
    share = {m: totals[m] / sum(totals.values()) / max(1, (y == m).sum()) for m in totals}
    return fit(x, y, np.where(y == 1, share[1], share[0]) * len(y))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            yield pa.RecordBatch.from_arrays([s["doc_id"], pa.array(shared.value.score(features(s["text"])))], ["doc_id", "score"])
    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels of documents
    whose crc32(id) leaves 2 on division by 4 are not learnt from."""
    known = marks(labels, "quality").filter(~held_out(F.col("doc_id"), 4, 2) & F.col("mark").isin(0, 1))
    model = train(docs.select("doc_id", "text"), known)
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                                      (F.col("score") >= 0.7).cast("int").alias("predicted"))

"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary documents, in two levels: the
class's continuation counts (in how many contexts, the distinct words before it,
a word stands in the class's documents) and the continuation counts of the whole
corpus, labelled or not, which both share.  A count loses a discount: D1, D2 or
D3+ of modified Kneser-Ney, estimated from the counts of counts, and at least
``ERRORS`` standard errors of the count (its root), so that words a class has a
few times by chance are left to the shared counts.  What the discounts take goes
to the shared level.  There is no level of word pairs above: it lowers what the
models find in documents they have not seen (figures in the README).

A document's evidence is the log-likelihood ratio of its words: divided by their
number, over the whole text and over its most toxic 3 and 20 words; and divided
by the root of their number, beside its logarithm, as chance moves the mean of a
short text further.  A logistic curve, fitted on labelled documents that the
models did not see, turns these into a score; a toxic document that it misses
weighs as much as ``MISSED`` ordinary ones that it reports.

Words are known by 64-bit hashes.  The shared counts come from the
distinct pairs of every document, which Spark counts by word.  The class models
come from a bounded sample of the labelled rows (``MOST_LABELLED`` of each
class, by a hash of the id), so the words they know are bounded too, and only
those words' shared counts are looked up: of a word that neither class has,
both models give the same share of the same shared probability, which is no
evidence whatever it is.

A word is a run of letters, digits and bytes over 127, A-Z lower-cased.

Defined cases: null and empty texts and texts without words have no evidence
and get the score of evidence 0; a null id is never labelled; a label row with
null mark is ignored; of several label rows of a document the largest mark
counts; with labels of one class only, or none, every score is that class's
(0.5 without any); extra columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm import words as W
from kollektiv.llm.common import arrow_map, byte_slices, stage_table

U = np.uint64
#: Least discount of a count, in standard errors.
ERRORS = 1.5
#: Words of the most toxic stretches.
WINDOWS = (3, 20)
#: Ordinary documents reported that weigh as much as a toxic one missed.
MISSED = 3.0
#: Labelled documents of each class that the models are learnt from, at most.
MOST_LABELLED = 8_000
#: One labelled document in so many is kept from the models for the curve.
HELD_FOR_CURVE = 4
#: Rounds in which the distinct pairs of the corpus are counted.
ROUNDS = 8

_LETTERS = np.zeros(256, bool)
_LETTERS[48:58] = _LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def letter_words(column: pa.Array) -> W.Words:
    return W.Words(column, lower=True, word_bytes=_LETTERS)


def _pairs(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each position: hash of the word before, hash of the pair.  The word
    before a text's first word is the same for all texts."""
    before = np.zeros(len(w), U)
    before[1:] = w.hash[:-1]
    before[w.off[:-1][w.counts > 0]] = 0
    return before, W.join2(before, w.hash)


def _place(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Row of each value in the ascending ``keys``, len(keys) if it has none."""
    if not len(keys):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, len(keys))


def _once(text: np.ndarray, *slots: np.ndarray) -> np.ndarray:
    """Positions of the first of equal (text, slots...) rows."""
    order = np.lexsort((*slots, text))
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (text, *slots)], axis=0)
    return order[new]


def discounts(n: np.ndarray) -> np.ndarray:
    """What is taken off the counts: D1, D2 or D3+ of modified Kneser-Ney, from
    how many counts are 1, 2, 3 and 4; at least ``ERRORS`` standard errors, at
    most the count."""
    of = np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6).astype(float)
    if not of[1] or not of[2]:
        return np.minimum(n, np.maximum(0.5, ERRORS * np.sqrt(n)))
    y = of[1] / (of[1] + 2 * of[2])
    d = np.zeros(4)
    for k in (1, 2, 3):
        # something always backs off; with too few counts to tell as for the one below
        d[k] = min(max(k - (k + 1) * y * of[k + 1] / of[k], 0.01), k) if of[k] else d[k - 1]
    return np.minimum(n, np.maximum(d[np.minimum(n, 3).astype(np.int64)], ERRORS * np.sqrt(n)))


#: What ``Model.evidence`` gives of a text.
EVIDENCE = ("whole", *(f"peak{n}" for n in WINDOWS), "sum", "size")


@dataclass
class Model:
    """log P(word | toxic) - log P(word | ordinary) by word."""

    words: np.ndarray           # ascending hashes; ratio has one row more, any other word's
    ratio: np.ndarray
    curve: tuple[float, ...] = (0.0,) * (len(EVIDENCE) + 1)

    def evidence(self, column: pa.Array) -> np.ndarray:
        """The ``EVIDENCE`` of each text."""
        w = letter_words(column)
        out = np.zeros((len(column), len(EVIDENCE)))
        if not len(w):
            return out
        sums = np.concatenate([[0.0], np.cumsum(self.ratio[_place(self.words, w.hash)])])
        counts = w.counts
        has = np.flatnonzero(counts)
        total = (sums[w.off[1:]] - sums[w.off[:-1]])[has]
        out[has, 0], out[has, -2], out[has, -1] = total / counts[has], total / np.sqrt(counts[has]), np.log(counts[has])
        text = w.text_of()
        for k, window in enumerate(WINDOWS):
            end = np.minimum(np.arange(len(w)) + window, w.off[text + 1])
            # a stretch at a text's end is as long as the others, or the whole text
            start = np.maximum(end - window, w.off[text])
            out[has, 1 + k] = np.maximum.reduceat((sums[end] - sums[start]) / (end - start), w.off[:-1][has])
        return out


def marks(labels: DataFrame, mark: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id, mark: one row per labelled document."""
    return (labels.filter(F.col(mark).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(mark).alias("mark")))


def sample_marks(known: DataFrame, most: int) -> tuple[dict[int, int], dict[int, int]]:
    """({id: mark} of at most ``most`` documents of each mark, by a hash of the
    id; {mark: documents}).  ``known``: doc_id, mark in (0, 1)."""
    totals = {int(r["mark"]): int(r["n"]) for r in known.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids: dict[int, int] = {}
    for m in totals:
        rows = known.filter(F.col("mark") == m).select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(most)
        ids.update((int(r["doc_id"]), m) for r in rows.collect())
    return ids, totals


def _for_curve(doc_id: int) -> bool:
    return zlib.crc32(b"curve%d" % doc_id) % HELD_FOR_CURVE == 0


def _continuations(docs: DataFrame) -> DataFrame:
    """word, contexts: in how many distinct contexts a word stands in ``docs``.
    Counted for a ``ROUNDS``-th of the words at a time, by hash, so that is what
    the shuffled pairs take on disk; each round reads the texts again."""
    def of(turn: int) -> DataFrame:
        def pairs(b: pa.RecordBatch):
            for s in byte_slices(b, "text"):
                w = letter_words(s["text"])
                before, pair = _pairs(w)
                mine = np.flatnonzero(w.hash % U(ROUNDS) == turn)
                at = mine[np.unique(pair[mine], return_index=True)[1]]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(w.hash[at].view(np.int64)), pa.array(before[at].view(np.int64))], ["word", "before"])
        # dealt by pair first, so a common word's contexts are counted in many tasks
        return (arrow_map(docs.select("text"), pairs, "word long, before long").distinct()
                .groupBy("word").agg(F.count(F.lit(1)).alias("contexts")))
    rounds = [stage_table(of(i), f"continuations-{i}") for i in range(ROUNDS)]
    return reduce(DataFrame.union, rounds)


def _class_contexts(docs: DataFrame) -> DataFrame:
    """word, ordinary, toxic: in how many distinct contexts a word stands in the
    documents of each mark.  ``docs``: mark, text."""
    def pairs(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            w = letter_words(s["text"])
            if not len(w):
                continue
            before, pair = _pairs(w)
            toxic = s["mark"].to_numpy().astype(np.int64)[w.text_of()]
            at = _once(toxic, pair)
            yield pa.RecordBatch.from_arrays([pa.array(w.hash[at].view(np.int64)), pa.array(before[at].view(np.int64)), pa.array(toxic[at])],
                                             ["word", "before", "mark"])
    return (arrow_map(docs.select("mark", "text"), pairs, "word long, before long, mark long").distinct()
            .groupBy("word").agg(F.count_if(F.col("mark") == 0).alias("ordinary"), F.count_if(F.col("mark") == 1).alias("toxic")))


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a bounded frame; hashes are signed in Spark."""
    t = df.toArrow()
    return {c: t[c].to_numpy().view(U) if c in ("word", "before") else t[c].to_numpy() for c in t.column_names}


def word_ratios(ordinary: np.ndarray, toxic: np.ndarray, shared: np.ndarray, n_pairs: int) -> np.ndarray:
    """Log ratio of each word's probabilities, and of any word that no class
    has, from its contexts in the classes and in the corpus (``n_pairs`` in all)."""
    base = np.append(shared, 1) / n_pairs
    p = []
    for n in (ordinary, toxic):
        n = np.append(n, 0).astype(float)
        less, total = discounts(n), max(n.sum(), 1.0)
        # a class without a single context has nothing but the shared counts
        p.append((n - less) / total + (less.sum() / total if n.sum() else 1.0) * base)
    return np.log(p[1] / p[0])


def train(docs: DataFrame, known: DataFrame, most: int = MOST_LABELLED) -> Model:
    """``docs``: doc_id, text.  ``known``: doc_id, mark (1 toxic, 0 ordinary)."""
    spark = docs.sparkSession
    marked, totals = sample_marks(known, most)
    learnt = spark.createDataFrame([(i, m) for i, m in marked.items() if not _for_curve(i)], "doc_id long, mark int")
    counts = _class_contexts(docs.join(F.broadcast(learnt), "doc_id"))         # bounded by the sample
    shared = _continuations(docs)
    # every pair of the corpus, one for the start of a text and one for a word it does not have
    n_pairs = (shared.agg(F.sum("contexts").alias("n")).first().n or 0) + 2
    common = _columns(counts.join(shared, "word"))
    order = np.argsort(common["word"])
    got = {c: common[c][order] for c in ("word", "ordinary", "toxic", "contexts")}
    model = Model(got["word"], word_ratios(got["ordinary"], got["toxic"], got["contexts"], n_pairs))
    model.curve = _curve(docs, marked, totals, model)
    return model


def evidence_of(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the ``EVIDENCE`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            e = shared.value.evidence(s["text"])
            yield pa.RecordBatch.from_arrays([*(s[k] for k in keep), *(pa.array(e[:, i]) for i in range(len(EVIDENCE)))], [*keep, *EVIDENCE])
    types = dict(docs.dtypes)
    return arrow_map(docs.select(*dict.fromkeys([*keep, "text"])), run, ", ".join([*(f"`{k}` {types[k]}" for k in keep), *(f"{e} double" for e in EVIDENCE)]))


def _curve(docs: DataFrame, marked: dict[int, int], totals: dict[int, int], model: Model) -> tuple[float, ...]:
    """Logistic curve over the labelled documents kept from the models, weighted
    to the classes' shares among all labelled documents and ``MISSED``."""
    flat = (0.0,) * len(EVIDENCE)
    if len(totals) < 2:
        return (0.0 if not totals else 30.0 if 1 in totals else -30.0, *flat)
    held = {i: m for i, m in marked.items() if _for_curve(i)} or marked
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i in held], "doc_id long")      # bounded by the sample
    seen = evidence_of(docs.join(F.broadcast(wanted), "doc_id", "left_semi"), model)
    # one row of a repeated id, so what is collected is bounded as well
    rows = seen.groupBy("doc_id").agg(F.max(F.struct(*EVIDENCE)).alias("e")).select("doc_id", "e.*").collect()
    x = np.array([[r[e] for e in EVIDENCE] for r in rows]).reshape(-1, len(EVIDENCE))
    y = np.array([held[r["doc_id"]] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return (0.0, 10.0, *flat[1:])
    share = {m: totals[m] * (MISSED if m else 1.0) / max(1, (y == m).sum()) for m in totals}
    weight = np.where(y == 1, share[1], share[0])
    return tuple(logistic(x, y, weight * len(y) / weight.sum()))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps: (intercept, slopes)."""
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    b = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ (weight * (y - p)) - ridge * b
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(b)), grad)
        b += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    slopes = b[1:] / sd
    return np.concatenate([[b[0] - mean @ slopes], slopes])


def held_out(doc_id, mod: int, remainder: int):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == remainder, F.lit(False))


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, score and predicted of every document."""
    z = reduce(lambda z, t: z + F.lit(float(t[0])) * F.col(t[1]), zip(model.curve[1:], EVIDENCE, strict=True), F.lit(float(model.curve[0])))
    return (evidence_of(docs, model, keep).withColumn("score", 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z)))))
            .select(*keep, "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels of
    documents whose crc32(id) is divisible by 5 are not learnt from."""
    known = marks(labels, "toxic").filter(~held_out(F.col("doc_id"), 5, 0) & F.col("mark").isin(0, 1))
    model = train(docs.select("doc_id", "text"), known)
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")

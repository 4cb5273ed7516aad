"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside long documents.  Comparing whole-text
sketches of such unequal sizes finds nothing, so items are partitioned by the
size of their shingle sets, and for each partition every document is read as
half-overlapping windows of twice its largest item: an item that stands in a
document lies whole in one of them, where its share of the window has a floor.

Sketches are one-permutation MinHash: ``BINS`` bins by hash, the least hash of
each.  A window and an item are a candidate if some bin agrees, so an item
copied for 80 % is missed with a chance of about 0.8 ** BINS.  An item of fewer
than ``FEW`` shingles has too few bins for that: any of its shingles makes it a
candidate.  Only shingles
that are some item's least need looking at, so a window's bins are worked out
when a shingle asks for them.  Candidates are verified by exact containment:
the item's distinct shingles that the whole document has.

Items are the query set: they are read in blocks of ``BLOCK`` items, and each
block goes over the documents once, where the texts are.  Nothing is shuffled.

Defined cases: words are split at ASCII white space, A-Z lower-cased; an item
of fewer words than a shingle is one shingle, its words in a row; items without
words (null, empty) are found nowhere; null texts hold nothing; repeated rows
and items each count; null ids are carried; an empty table gives no rows;
columns other than the id and the text are not read (``clean`` keeps them).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm import words as W
from kollektiv.llm.common import arrow_map, byte_slices

U = np.uint64
SHINGLE, PERCENT = 5, 80
BINS = 128
FEW = 4
#: Items that one pass looks for.
BLOCK = 20_000
_FILTER = 1 << 22


def _bin(h: np.ndarray) -> np.ndarray:
    return (h >> U(57)).astype(np.int64)


@dataclass
class Items:
    """The sets of a block of items and what their sketches hold."""

    ids: list
    sets: list[np.ndarray]
    lengths: np.ndarray                        # words of a shingle: SHINGLE, or all of a shorter item
    least: dict[tuple[int, int], tuple]        # (words, window): (sorted least hashes, items of each)
    filters: dict[tuple[int, int], np.ndarray]

    @staticmethod
    def of(ids: list, texts: list[str | None], shingle: int = SHINGLE) -> Items:
        w = W.Words(pa.array([t or "" for t in texts], pa.string()), lower=True)
        counts = w.counts
        sets, lengths, groups = [], np.minimum(counts, shingle), {}
        for i in range(len(ids)):
            k = int(lengths[i])
            x = np.unique(W.grams(w.hash[w.off[i]:w.off[i + 1]], k)) if k else np.zeros(0, U)
            sets.append(x)
            if len(x):
                size = 1 << int(len(x) - 1).bit_length()       # 1, 2, 4, 8, ...
                first = np.flatnonzero(np.concatenate([[True], np.diff(_bin(x)) > 0]))
                for h in x if len(x) < FEW else x[first]:
                    groups.setdefault((k, 2 * max(size, 4)), {}).setdefault(int(h), []).append(i)
        least, filters = {}, {}
        for key, g in groups.items():
            hashes = np.array(sorted(g), U)
            least[key] = (hashes, [g[int(h)] for h in hashes])
            filters[key] = np.zeros(_FILTER, bool)
            filters[key][(hashes % U(_FILTER)).astype(np.int64)] = True
        return Items(ids, sets, lengths, least, filters)

    def candidates(self, grams: dict[int, np.ndarray]) -> set[int]:
        """Items that share a sketch bin with a window of the document.
        ``grams``: its shingle hashes, in order, by shingle length."""
        out: set[int] = set()
        for (k, span), (hashes, items) in self.least.items():
            g = grams[k]
            at = np.flatnonzero(self.filters[k, span][(g % U(_FILTER)).astype(np.int64)])
            if not len(at):
                continue
            place = np.minimum(np.searchsorted(hashes, g[at]), len(hashes) - 1)
            known = hashes[place] == g[at]
            half = span // 2
            for p, i in zip(at[known].tolist(), place[known].tolist(), strict=True):
                if out.issuperset(items[i]):
                    continue
                few = [j for j in items[i] if len(self.sets[j]) < FEW]
                out.update(few)
                if len(few) == len(items[i]):
                    continue
                block = p // half
                for lo in {max(block - 1, 0) * half, block * half}:
                    window = g[lo:lo + span]
                    if window[_bin(window) == _bin(g[p:p + 1])].min() == g[p]:
                        out.update(items[i])
                        break
        return out

    def matches(self, column: pa.Array, percent: int = PERCENT) -> list[tuple[int, int, int]]:
        """(text, item, common shingles) of every contained item."""
        w = W.Words(column, lower=True)
        found = []
        for k in sorted({k for k, _ in self.least}):
            all_grams = W.grams(w.hash, k)
            keys = {key: v for key, v in self.least.items() if key[0] == k}
            # texts with no shingle that is some item's least are done
            hit = np.zeros(len(all_grams), bool)
            low = (all_grams % U(_FILTER)).astype(np.int64)
            for key in keys:
                hit |= self.filters[key][low]
            texts = np.unique(w.text_of()[:len(hit)][hit])
            one = Items(self.ids, self.sets, self.lengths, keys, self.filters)
            for t in texts.tolist():
                g = all_grams[w.off[t]:max(w.off[t], w.off[t + 1] - k + 1)]
                got = one.candidates({k: g}) if len(g) else ()
                if got:
                    own = np.unique(g)
                    for i in sorted(got):
                        at = np.minimum(np.searchsorted(own, self.sets[i]), len(own) - 1)
                        common = int((own[at] == self.sets[i]).sum())
                        if 100 * common >= percent * len(self.sets[i]):
                            found.append((t, i, common))
        return found


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = BLOCK):
    """``Items`` of up to ``size`` rows each; the driver holds one at a time."""
    ids, texts = [], []
    for r in items.select(id_col, text_col).toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        if len(ids) == size:
            yield Items.of(ids, texts)
            ids, texts = [], []
    if ids:
        yield Items.of(ids, texts)


def contained(docs: DataFrame, items: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, n_shingles, n_common, containment: every document and
    item it contains."""
    schema = "doc_id long, item_id long, n_shingles long, n_common long"
    out = docs.sparkSession.createDataFrame([], schema)
    for got in blocks(items, size=block):
        shared = docs.sparkSession.sparkContext.broadcast(got)

        def run(b: pa.RecordBatch, shared=shared):
            its = shared.value
            for s in byte_slices(b, "text"):
                m = its.matches(s["text"], percent)
                if m:
                    yield pa.RecordBatch.from_arrays(
                        [s["doc_id"].take(pa.array([t for t, _, _ in m])), pa.array([its.ids[i] for _, i, _ in m], pa.int64()),
                         pa.array([len(its.sets[i]) for _, i, _ in m], pa.int64()), pa.array([c for _, _, c in m], pa.int64())],
                        ["doc_id", "item_id", "n_shingles", "n_common"])
        out = out.union(arrow_map(docs.select("doc_id", "text"), run, schema))
    return out.withColumn("containment", F.col("n_common") / F.col("n_shingles"))


def clean(docs: DataFrame, items: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    for got in blocks(items, size=block):
        shared = docs.sparkSession.sparkContext.broadcast(got)

        def run(b: pa.RecordBatch, shared=shared):
            for s in byte_slices(b, "text"):
                keep = np.ones(s.num_rows, bool)
                keep[[t for t, _, _ in shared.value.matches(s["text"], percent)]] = False
                yield s.filter(pa.array(keep))
        docs = arrow_map(docs, run, docs.schema)
    return docs

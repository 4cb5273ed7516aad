"""Substring dedup with repeated-phrase automata.

Words covered by a window (``WINDOW`` consecutive words of a text) whose words
also start earlier, in a smaller document or further left, are removed.

1. *Seeds.*  Of every window one phrase of ``SEED`` words is chosen by its
   hash, the same one wherever the window stands.  Phrases chosen only once in
   the corpus rule their windows out.
2. *Confirm.*  Documents go to shards of bounded size, and the other windows
   are counted by hash.  Of those that recur, each shard that has one again is
   told where it stands first.
3. *Compile.*  What a shard has again is cut out of the documents that have it
   first, as passages of bounded length.  A shard so gets no more windows than
   its own text has.  It builds one Aho-Corasick automaton (over word numbers)
   from the passages' blocks: every window holds a whole block.
4. *Stream.*  The shard's documents run through it.  Each hit is extended to
   both sides word by word, which proves the match and gives every occurrence.

Seeds and windows are 64-bit hashes, but what is removed is compared as words.

Defined cases: null, empty and short texts lose nothing; null ids come after
all others; rows with equal id are ordered by text, and rows alike in both are
one document whose result each of them gets; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm import words as W
from kollektiv.llm.common import POSITION_BITS, arrow_map, byte_slices, keyed, per_row, shards, stage_bucketed, stage_table
from kollektiv.session import StagingScope, use_scope

WINDOW = 20
SEED = 8
#: Windows of a passage, at most: 2 ** PASSAGE_BITS, flagged in numbers of MASK_BITS.
PASSAGE_BITS = 8
MASK_BITS = 64
MASKS = [f"m{i}" for i in range((1 << PASSAGE_BITS) // MASK_BITS)]
#: Text of a shard, about.
SHARD_BYTES = 12 << 20
#: Characters of a word in the automaton.
SYMBOLS = 3
#: Words of a block: a window that starts anywhere holds a whole one.
BLOCK = WINDOW // 2


def _chosen(g: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest (leftmost, if equal) of each ``span``
    consecutive hashes, by doubling."""
    at, have = np.arange(len(g)), 1
    while have < span:
        step = min(have, span - have)
        left, right = at[:-step], at[step:]
        at = np.where(g[left] <= g[right], left, right)
        have += step
    return at


def _windows(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, text and seed position of every window that lies in one text,
    with the seeds' hashes by position."""
    g = W.grams(w.hash, SEED)
    if len(w) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, g
    seed = _chosen(g, WINDOW - SEED + 1)
    text = w.text_of()[:len(seed)]
    start = np.flatnonzero(np.arange(len(seed)) + WINDOW <= w.off[text + 1])
    return start, text[start], seed[start], g


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], list(columns))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def seeds(docs: DataFrame) -> DataFrame:
    """seed, key, n: seeds of each document and how often it has them."""
    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            w = W.Words(s["text"])
            _, _, at, g = _windows(w)
            if not len(at):
                continue
            at = np.unique(at)
            text, h = w.text_of()[at], g[at]
            order = np.lexsort((h, text))
            text, h = text[order], h[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]))
            n = np.diff(np.append(new, len(h)))
            yield _batch(seed=_signed(h[new]), key=s["key"].to_numpy()[text[new]], n=n)
    return arrow_map(docs, run, "seed long, key long, n long")


#: Rows taken at once from the sorted streams below.
_ROWS = 1 << 16


def _by_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of some batches together, ``_ROWS`` rows or so."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= _ROWS:
            yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            held, n = [], 0
    if n:
        yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]


def _sorted_map(df: DataFrame, fn: Callable, parts: int, by: list[str], schema: str) -> DataFrame:
    """``fn`` (of column arrays, a part's in order) over rows dealt by the first
    column of ``by`` and sorted by all: equal values come one after the other."""
    return (df.repartition(parts, by[0]).sortWithinPartitions(*by)
            .mapInArrow(lambda batches: fn(_by_rows(batches)), schema))


def recurring_seeds(seen: DataFrame, parts: int) -> DataFrame:
    """seed, key of the seeds that are chosen more than once.  ``seen``: seed, key, n."""
    def run(chunks):
        last, open_key = None, None                # the latest seed; its key, while only chosen once
        for seed, key, n in chunks:
            if open_key is not None:
                seed, key, n = np.append(last, seed), np.append(open_key, key), np.append(1, n)
            goes_on = open_key is None and last is not None and seed[0] == last
            new = np.concatenate([[not goes_on], seed[1:] != seed[:-1]])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(seed)))
            alone = first[(size == 1) & (n[first] == 1)]
            keep = np.ones(len(seed), bool)
            keep[alone] = False
            last, open_key = seed[-1], key[-1] if len(alone) and alone[-1] == len(seed) - 1 else None
            yield _batch(seed=seed[keep], key=key[keep])
    return _sorted_map(seen, run, parts, ["seed"], "seed long, key long")


def window_rows(candidates: DataFrame) -> DataFrame:
    """window, place, shard, n: the windows of each slice of ``candidates`` (shard,
    key, text, seeds that recur) with a seed that recurs: the first place of each
    in a shard, and how often it stands there."""
    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            w = W.Words(s["text"])
            start, text, at, g = _windows(w)
            if not len(start):
                continue
            own = s["seeds"]
            flat = own.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(own)), np.diff(own.offsets.to_numpy()))
            # (text, seed) pairs of the windows that are among the document's recurring ones
            with np.errstate(over="ignore"):
                keep = np.isin(W.join2(text.astype(np.uint64), g[at]), W.join2(owner.astype(np.uint64), flat))
            start, text = start[keep], text[keep]
            if not len(start):
                continue
            h = _signed(W.grams(w.hash, WINDOW)[start])
            place = s["key"].to_numpy()[text] << POSITION_BITS | start - w.off[text]
            shard = s["shard"].to_numpy()[text]
            order = np.lexsort((shard, h))
            h, place, shard = h[order], place[order], shard[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (shard[1:] != shard[:-1])]))
            yield _batch(window=h[new], place=np.minimum.reduceat(place, new), shard=shard[new],
                         n=np.diff(np.append(new, len(h))))
    return arrow_map(candidates, run, "window long, place long, shard int, n long")


def recurring_windows(rows: DataFrame, parts: int) -> DataFrame:
    """place, dest: where each window that recurs stands first, for every shard
    that has it elsewhere too.  ``rows``: window, place, shard, n."""
    def run(chunks):
        last, start = None, 0                      # the latest window and its first place
        for window, place, shard, n in chunks:
            goes_on = last is not None and window[0] == last
            new = np.concatenate([[not goes_on], window[1:] != window[:-1]])
            first = np.flatnonzero(new)
            # the first place of each row's window: rows before the first new one go on with the last
            firsts = np.append(start, place[first])[np.cumsum(new)]
            last, start = window[-1], firsts[-1]
            keep = ~new | (n > 1)
            yield _batch(place=firsts[keep], dest=shard[keep])
    return _sorted_map(rows, run, parts, ["window", "place"], "place long, dest int")


def passages(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """dest, owner, start, words: what each shard is to get, cut out of the
    documents as passages of ``2 ** PASSAGE_BITS`` windows at most.  ``docs``:
    shard, key, text; ``wanted``: shard (of the document), passage, dest and
    flags of the passage's windows."""
    low = POSITION_BITS - PASSAGE_BITS

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"dest": [], "owner": [], "start": [], "words": []}
        order = np.argsort(right["passage"].to_numpy(), kind="stable")
        passage, dest = right["passage"].to_numpy()[order], right["dest"].to_numpy()[order]
        flags = np.stack([right[m].to_numpy()[order] for m in MASKS], axis=1).astype("<i8").view(np.uint8)
        for s in (s for b in left.to_batches() for s in byte_slices(b, "text")):
            keys = s["key"].to_numpy()
            since, until = (np.searchsorted(passage, k << low) for k in (keys, keys + 1))
            has = np.flatnonzero(since < until)
            if not len(has):
                continue
            w = W.Words(s["text"].take(pa.array(has)))
            for t, i in enumerate(has.tolist()):
                pieces: dict[tuple[int, bytes], list] = {}
                for r in range(since[i], until[i]):
                    what = int(passage[r]), flags[r].tobytes()
                    if what not in pieces:
                        pieces[what] = list(_cut(w, t, (what[0] & (1 << low) - 1) << PASSAGE_BITS, flags[r]))
                    for first, words in pieces[what]:
                        out["dest"].append(int(dest[r]))
                        out["owner"].append(int(keys[i]))
                        out["start"].append(first)
                        out["words"].append(words)
        return pa.table({"dest": pa.array(out["dest"], pa.int32()), "owner": pa.array(out["owner"], pa.int64()),
                         "start": pa.array(out["start"], pa.int64()), "words": pa.array(out["words"], pa.binary())})
    return (docs.groupBy("shard").cogroup(wanted.groupBy("shard"))
            .applyInArrow(run, "dest int, owner long, start long, words binary"))


def _cut(w: W.Words, text: int, offset: int, flags: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Start and words of the passages of a text's flagged windows."""
    at = np.flatnonzero(np.unpackbits(flags, bitorder="little")) + offset
    # runs of windows that touch no other window are passages of their own
    for run_of in np.split(at, np.flatnonzero(np.diff(at) > BLOCK) + 1):
        first, last = int(run_of[0]), int(run_of[-1]) + WINDOW
        yield first, w.data[w.start[w.off[text] + first]:w.end[w.off[text] + last - 1]].tobytes()


class Automaton:
    """Passages (owner, start, words) of a shard: their blocks in one
    Aho-Corasick automaton over word numbers, and where each window of theirs
    stands first."""

    def __init__(self, owners: list[int], starts: list[int], texts: pa.Array):
        import ahocorasick
        order = np.lexsort((np.asarray(starts, np.int64), np.asarray(owners, np.int64)))
        w = W.Words(texts.take(pa.array(order)))
        passage = w.text_of()
        self.owner = np.asarray(owners, np.int64)[order][passage]
        # position in its document of each word
        self.at = np.asarray(starts, np.int64)[order][passage] + np.arange(len(w)) - w.off[passage]
        self.vocabulary, number = np.unique(w.hash, return_inverse=True)
        self.words = number + 1
        start, _, _, _ = _windows(w)
        # of equal windows the first place counts: passages are in order
        self.windows, first = np.unique(W.grams(w.hash, WINDOW)[start], return_index=True)
        self.places = start[first]
        block = np.flatnonzero(((np.arange(len(w)) - w.off[passage]) % BLOCK == 0) & (np.arange(len(w)) + BLOCK <= w.off[passage + 1]))
        _, one = np.unique(W.grams(w.hash, BLOCK)[block], return_index=True)
        self.base = max(64, math.ceil((len(self.vocabulary) + 1) ** (1 / SYMBOLS)) + 1)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        spelt = self._spelt(self.words)
        for b in block[one].tolist():
            self.found.add_word(spelt[b * SYMBOLS:(b + BLOCK) * SYMBOLS], 1)
        if len(one):
            self.found.make_automaton()

    def _spelt(self, numbers: np.ndarray) -> str:
        """Word numbers as ``SYMBOLS`` characters each.  A node of the automaton
        searches its children one by one, so there must not be a child for every
        word.  First characters are of their own: no match starts inside a word."""
        digits = np.empty((len(numbers), SYMBOLS), "<u4")
        for i in range(SYMBOLS):
            digits[:, i] = numbers // self.base ** i % self.base + 1
        digits[:, 0] += self.base
        return digits.tobytes().decode("utf-32-le")

    def removed(self, w: W.Words, keys: np.ndarray) -> np.ndarray:
        """Which words go, of texts with these document keys."""
        gone = np.zeros(len(w), bool)
        if len(w) < WINDOW or not len(self.windows):
            return gone
        at = np.minimum(np.searchsorted(self.vocabulary, w.hash), len(self.vocabulary) - 1)
        doc = np.where(self.vocabulary[at] == w.hash, at + 1, 0)
        ends = np.fromiter((e for e, _ in self.found.iter(self._spelt(doc))), np.int64) // SYMBOLS
        if not len(ends):
            return gone
        # the windows that hold a block that was found, and lie in one text
        edge = np.zeros(len(w) + 1, np.int64)
        np.add.at(edge, np.maximum(ends - WINDOW + 1, 0), 1)
        np.add.at(edge, ends - BLOCK + 2, -1)
        text = w.text_of()
        s = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        s = s[s + WINDOW <= w.off[text[s] + 1]]
        h = W.grams(w.hash, WINDOW)[s]
        place = np.minimum(np.searchsorted(self.windows, h), len(self.windows) - 1)
        known = self.windows[place] == h
        s, place = s[known], self.places[place[known]]
        for k in range(WINDOW):                    # word by word
            same = doc[s + k] == self.words[place + k]
            s, place = s[same], place[same]
        key, here = np.asarray(keys)[text[s]], s - w.off[text[s]]
        s = s[(self.owner[place] < key) | (self.owner[place] == key) & (self.at[place] < here)]
        cover = np.zeros(len(w) + 1, np.int64)
        np.add.at(cover, s, 1)
        np.add.at(cover, s + WINDOW, -1)
        return np.cumsum(cover[:-1]) > 0


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def found(docs: DataFrame, routed: DataFrame) -> DataFrame:
    """key, removed (ascending positions of the words that go), kept_sha256, of
    documents that lose any.  ``docs``: shard, key, text; ``routed``: shard,
    owner, start, words."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_key, out_gone, out_kept = [], [], []
        if left.num_rows and right.num_rows:
            auto = Automaton(right["owner"].to_pylist(), right["start"].to_pylist(), right["words"].combine_chunks())
            for s in (s for b in left.to_batches() for s in byte_slices(b, "text")):
                w, keys = W.Words(s["text"]), s["key"].to_numpy()
                gone = auto.removed(w, keys)
                for t in np.unique(w.text_of()[gone]):
                    own = gone[w.off[t]:w.off[t + 1]]
                    out_key.append(int(keys[t]))
                    out_gone.append(np.flatnonzero(own).astype(np.int32))
                    out_kept.append(_digest([x for x, g in zip(w.list(t), own.tolist(), strict=True) if not g]))
        return pa.table({"key": pa.array(out_key, pa.int64()), "removed": pa.array(out_gone, pa.list_(pa.int32())),
                         "kept_sha256": pa.array(out_kept, pa.string())})
    return (docs.groupBy("shard").cogroup(routed.groupBy("shard"))
            .applyInArrow(run, "key long, removed array<int>, kept_sha256 string"))


def _shard(key, n: int):
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def candidate_texts(docs: DataFrame, again: DataFrame, n: int) -> DataFrame:
    """shard, key, text, seeds (that recur) of the documents that have any,
    staged by shard.  ``again``: seed, key."""
    shard = _shard(F.col("key"), n).alias("shard")
    by_doc = (again.select("key", shard, "seed").repartition(n, "shard").groupBy("shard", "key")
              .agg(F.collect_list("seed").alias("seeds")))
    texts = docs.select(shard, "key", "text").repartition(n, "shard").join(by_doc, ["shard", "key"])
    return stage_bucketed(texts, "candidates", "shard", n, dealt=True)


def wanted_passages(firsts: DataFrame, n: int) -> DataFrame:
    """shard (of the document), passage, dest and which windows of the passage
    the shard ``dest`` is to get.  ``firsts``: place, dest."""
    in_passage = F.col("place").bitwiseAND((1 << PASSAGE_BITS) - 1)
    flag = F.expr(f"shiftleft(1L, cast(at % {MASK_BITS} as int))")
    masks = [F.bit_or(F.when(F.expr(f"at div {MASK_BITS}") == i, flag).otherwise(F.lit(0).cast("long"))).alias(m)
             for i, m in enumerate(MASKS)]
    return (firsts.select(_shard(F.shiftright("place", POSITION_BITS), n).alias("shard"),
                          F.shiftright("place", PASSAGE_BITS).alias("passage"), "dest", in_passage.alias("at"))
            .repartition(n, "shard").groupBy("shard", "passage", "dest").agg(*masks))


def removals(docs: DataFrame) -> DataFrame:
    """key, removed, kept_sha256 of every document that loses words.
    ``docs``: key, text."""
    spark = docs.sparkSession
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n, parts = max(1, -(-size // SHARD_BYTES)), shards(spark, size, SHARD_BYTES)
    # each staged table goes as soon as it has been read
    seeded, texts, routes = StagingScope(), StagingScope(), StagingScope()
    try:
        with use_scope(seeded):
            again = stage_table(recurring_seeds(seeds(docs), parts), "recurring-seeds")
        with use_scope(texts):
            candidates = candidate_texts(docs, again, n)
        seeded.drop(spark)
        with use_scope(routes):
            firsts = stage_table(recurring_windows(window_rows(candidates), parts), "first-places")
        text = candidates.select("shard", "key", "text")
        routed = passages(text, wanted_passages(firsts, n)).withColumnRenamed("dest", "shard")
        return stage_table(found(text, routed), "removals")
    finally:
        for scope in (seeded, texts, routes):
            scope.drop(spark)


def phrase_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    texts, rows = keyed(docs)
    gone = removals(texts)

    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            words = [t.as_py().encode().split() for t in s["text"]]
            yield _batch(key=s["key"], n_words=pa.array(list(map(len, words)), pa.int64()), whole=pa.array(list(map(_digest, words))))

    whole = arrow_map(texts, run, "key long, n_words long, whole string")
    part = gone.select("key", F.size("removed").cast("long").alias("n_removed"), "kept_sha256")
    result = (whole.join(part, "key", "left")
              .select("key", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("kept_sha256", "whole").alias("kept_sha256")))
    return per_row(result, rows).select("doc_id", "n_words", "n_removed", "kept_sha256")

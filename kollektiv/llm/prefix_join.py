"""N-gram Jaccard join over prefix trees.

Documents are sets of hashed word n-grams, ordered by hash.

1. Documents with equal sets are one class; the smallest key stands for it.
2. Sets of similar sizes cut the hash space into the same ranges, some more than
   the n-grams in which two similar sets can differ.  So similar sets have a range
   that holds the same n-grams in both, at least one; a hash of those is a
   signature.  A set with so many empty ranges that this may fail adds its prefix
   (the first ``n - ceil(t * n) + 1`` n-grams), of which similar sets share one.
   A passage that many documents quote is no signature, as a range holds other
   n-grams as well.
3. Of the sets with a common signature, one leads, another each round.  Sets whose
   leader is in another component, and whose folded n-gram parities (a bitmap, in
   which sets differ in no more bits than in n-grams) allow it to be similar, form
   the leader's group.
4. A group is joined in one task: its sets are stored in a trie, smaller ones
   first, and each set walks the trie before it goes in.  A walk shares the
   overlap counted so far, and leaves a branch when the overlap so far and the
   n-grams left cannot reach the threshold, or when the set at its end is
   already connected.  Groups above ``GROUP`` documents are split; the leader and
   some documents of the group go into every part and connect the parts.
5. What is open then, sets of different components with a common signature, is
   compared by bitmaps, large crowds dealt in blocks so that every two blocks
   meet in a task.  Pairs that the bitmaps allow are verified one by one.

No link between different components is lost; links inside one are not listed.

Defined cases: texts without words (null, empty) have no n-grams and are linked
with nothing, themselves included in the result; a text with fewer words than
an n-gram has one, the whole; null ids come after all others; rows alike in id
and text are one document whose result each of them gets; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm import words as W
from kollektiv.llm.common import arrow_map, byte_slices, keyed, per_row, shards, stage_bucketed, stage_table
from kollektiv.llm.components import components
from kollektiv.session import StagingScope, use_scope

U = np.uint64
#: Rounds of leaders, at most.
ROUNDS = 5
#: Documents that one task joins at once, and those that connect the parts of a larger group.
GROUP, LEADERS = 1000, 16
#: Open sets with a common signature: more are dealt in blocks.
CROWD = 32
#: Sets are cut alike while their sizes differ by less than this power of 100 / percent.
STEPS = 3
#: Text per n-gram, about: for the number of tasks.
GRAM_BYTES = 7
#: N-grams of a trie edge.
EDGE = 48


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], list(columns))


def least_overlap(na: int, nb: int, percent: int) -> int:
    """Smallest common count at which 100 * common >= percent * union."""
    return -(-percent * (na + nb) // (100 + percent))


def most_apart(na: int, nb: int, percent: int) -> int:
    """N-grams that only one of two similar sets of these sizes may have."""
    return (100 - percent) * (na + nb) // (100 + percent)


@lru_cache(maxsize=64)
def size_classes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest size, ranges) of each class of sizes up to ``largest`` and two
    beyond; 0 ranges where similar sets are equal."""
    ratio = max(2.0 if percent == 100 else 1.0, (100 / percent) ** STEPS)
    low, ranges = [1], []
    while len(low) < 4 or low[-3] <= largest:
        low.append(max(low[-1] + 1, math.ceil(low[-1] * ratio)))
    for first in low[1:]:
        apart = most_apart(first - 1, first - 1, percent)
        # a few more than needed, for ranges that are empty
        ranges.append(apart + 3 + math.ceil(2 * apart * math.exp(-(first - 1) / (apart + 1))) if apart else 0)
    return np.array(low, np.int64), np.array([*ranges, 0], np.int64)


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) by set.  Similar sets that differ have one in common.

    A set is cut as its class of sizes is, and as the next if a similar set can
    be in that."""
    sizes = np.array([len(x) for x in sets], np.int64)
    low, ranges = size_classes(percent, 1 << max(4, int(sizes.max(initial=1)).bit_length()))
    own = np.searchsorted(low, sizes, "right") - 1
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for step in (0, 1):
        of = own + step
        cut = (sizes > 0) & (ranges[of] > 0)
        if step:
            cut &= sizes * 100 // percent >= low[of]
        at = np.flatnonzero(cut)
        if not len(at):
            continue
        flat = np.concatenate([sets[i] for i in at])
        n, m, label = sizes[at], ranges[of[at]], of[at]
        row = np.repeat(np.arange(len(at)), n)
        part = (flat >> U(32)) * m.astype(U)[row] >> U(32)
        first = np.concatenate([[True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])])
        start = np.flatnonzero(first)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(W.mix(flat), start)
            salt = W.mix(label.astype(U) + U(0x51ED270B))
            found = W.mix(sums + part[start] * U(0x9E3779B97F4A7C15) ^ salt[row[start]])
        out.append((found, at[row[start]]))
        filled = np.bincount(row[start], minlength=len(at))
        largest = np.minimum(low[label + 1] - 1, n * 100 // percent)
        for i in np.flatnonzero(filled <= (100 - percent) * (n + largest) // (100 + percent)).tolist():
            x = sets[at[i]][:n[i] - -(-percent * n[i] // 100) + 1]
            out.append((W.mix(x ^ U(~salt[i])), np.full(len(x), at[i])))
    if not out:
        return np.zeros(0, U), np.zeros(0, np.int64)
    found, owner = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.argsort(owner, kind="stable")
    return found[order], owner[order]


def _parities(sets: list[np.ndarray]) -> pa.Array:
    """Bitmaps of at least two bits per n-gram, a power of two: whether the
    n-grams whose lowest bits name a bit are odd in number."""
    width = np.array([max(64, 1 << (2 * len(x) - 1).bit_length()) if len(x) else 64 for x in sets], np.int64)
    ends = np.cumsum(width)
    sizes = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, U)
    at = (flat & np.repeat((width - 1).astype(U), sizes)).astype(np.int64) + np.repeat(ends - width, sizes)
    bits = np.packbits(np.bincount(at, minlength=int(ends[-1]) if len(ends) else 0).astype(np.uint8) & 1, bitorder="little")
    off = np.concatenate([[0], ends // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer(off), pa.py_buffer(bits)])


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words, folded to ``words`` of them."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _may_link(x: np.ndarray, y: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of bitmaps ``x`` and ``y`` sets of these sizes may be similar."""
    words = min(x.shape[1], y.shape[1])
    apart = np.bitwise_count(_fold(x, words) ^ _fold(y, words)).sum(axis=-1, dtype=np.int64)
    return ((100 + percent) * apart <= (100 - percent) * (na + nb)) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """key, n, f1, f2, bits: each document's set in short, its size,
    fingerprints and bitmap."""
    def run(b: pa.RecordBatch):
        for s in byte_slices(b, "text"):
            sets = W.text_sets(W.Words(s["text"], lower=True), words)
            n = np.array([len(x) for x in sets], np.int64)
            flat = np.concatenate(sets) if len(sets) else np.zeros(0, U)
            ends = np.cumsum(n)
            with np.errstate(over="ignore"):
                f = [np.concatenate([[U(0)], np.cumsum(W.mix(flat ^ U(salt)))]) for salt in (0x51ED270B, 0xC2B2AE3D27D4EB4F)]
                f1, f2 = ((c[ends] - c[ends - n]).view(np.int64) for c in f)
            yield _batch(key=s["key"], n=n, f1=f1, f2=f2, bits=_parities(sets))
    return arrow_map(docs, run, "key long, n long, f1 long, f2 long, bits binary")


def shared_signatures(docs: DataFrame, words: int, percent: int, parts: int) -> DataFrame:
    """gram, key: the signatures that several documents have."""
    def listed(b: pa.RecordBatch):
        for x in byte_slices(b, "text"):
            found, owner = signatures(W.text_sets(W.Words(x["text"], lower=True), words), percent)
            yield _batch(gram=found.view(np.int64), key=x["key"].to_numpy()[owner])

    def several(batches):
        gram, key, inside = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)     # the last row seen
        for b in batches:
            if not b.num_rows:
                continue
            gram, key = np.concatenate([gram, b["gram"].to_numpy()]), np.concatenate([key, b["key"].to_numpy()])
            same = gram[1:] == gram[:-1]
            held = np.concatenate([inside if len(inside) else [False], same])
            held[:-1] |= same
            yield _batch(gram=gram[:-1][held[:-1]], key=key[:-1][held[:-1]])
            gram, key, inside = gram[-1:], key[-1:], held[-1:]
        yield _batch(gram=gram[inside], key=key[inside])
    rows = arrow_map(docs.select("key", "text"), listed, "gram long, key long")
    return rows.repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(several, "gram long, key long")


class Trie:
    """Ordered sets that share what they begin with alike.  An edge holds up to
    ``EDGE`` n-grams; a node's children go by the first n-gram of their edge."""

    __slots__ = ("grams", "has", "kids", "ends")

    def __init__(self, grams: tuple = ()):
        self.grams, self.has, self.kids, self.ends = grams, frozenset(grams), {}, []

    def add(self, x: tuple, doc: int) -> None:
        node, at = self, 0
        while at < len(x):
            kid = node.kids.get(x[at])
            if kid is None:
                kid = node.kids[x[at]] = Trie(x[at:at + EDGE])
            same = 0
            for p, q in zip(kid.grams, x[at:at + len(kid.grams)], strict=False):
                if p != q:
                    break
                same += 1
            if same < len(kid.grams):                 # the edge forks here
                upper = node.kids[x[at]] = Trie(kid.grams[:same])
                kid.grams = kid.grams[same:]
                kid.has = frozenset(kid.grams)
                upper.kids[kid.grams[0]] = kid
                kid = upper
            node, at = kid, at + same
        node.ends.append(doc)


def join_group(sets: list[np.ndarray], percent: int, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that connect all similar sets of the group; sets with the
    same ``known`` component are connected from the start."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    parent = list(range(len(sets)))
    if known is not None:
        first: dict[int, int] = {}
        parent = [first.setdefault(c, i) for i, c in enumerate(known)]

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    trie, links = Trie(), []
    for i in order:
        x = sets[i].tolist()
        n = len(x)
        if not n:
            continue
        own, least = set(x), -(-percent * n // 100)           # partners have least..n n-grams
        lowest = least_overlap(n, least, percent)
        most = n - least_overlap(n, n, percent)                # n-grams of a partner that may be missing here
        todo = [(trie, 0, 0)]
        while todo:
            node, common, depth = todo.pop()
            for j in node.ends:                                # the path is all of j
                if depth >= least and common >= least_overlap(n, depth, percent) and root(i) != root(j):
                    links.append((i, j))
                    parent[root(i)] = root(j)
            for kid in node.kids.values():
                if not kid.kids and all(root(j) == root(i) for j in kid.ends):
                    continue
                both = common + len(own & kid.has)
                far = depth + len(kid.grams)
                # later n-grams of the branch are among the later ones of this set
                if far - both <= most and both + n - bisect_right(x, kid.grams[-1]) >= lowest:
                    todo.append((kid, both, far))
        trie.add(tuple(x), i)
    return links


def _grouped(batches, fn):
    """Calls ``fn(group rows)`` for runs of equal ``gid`` in sorted batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        ids = b["gid"].to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                if held and held[0]["gid"][0].as_py() != ids[lo]:
                    yield fn(pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(lo, hi - lo))
    if held:
        yield fn(pa.Table.from_batches(held))


def _sets_of(t: pa.Table, words: int) -> list[np.ndarray]:
    return W.text_sets(W.Words(t["text"].combine_chunks(), lower=True), words)


def _edges(pairs) -> pa.RecordBatch:
    return _batch(a=pa.array([a for a, _ in pairs], pa.int64()), b=pa.array([b for _, b in pairs], pa.int64()))


def links_in_groups(members: DataFrame, words: int, percent: int, parts: int) -> DataFrame:
    """a, b: links that connect the similar documents of each group.
    ``members``: gid, key, text, and the component if it is known."""
    def run(batches):
        def one(t: pa.Table) -> pa.RecordBatch:
            keys = t["key"].to_pylist()
            known = t["component"].to_pylist() if "component" in t.column_names else None
            return _edges([(keys[i], keys[j]) for i, j in join_group(_sets_of(t, words), percent, known)])
        yield from _grouped(batches, one)
    return members.repartition(parts, "gid").sortWithinPartitions("gid").mapInArrow(run, "a long, b long")


def links_of_pairs(pairs: DataFrame, texts: DataFrame, words: int, percent: int, parts: int) -> DataFrame:
    """a, b: the pairs that are similar.  ``pairs``: gid, a, b; each document
    goes once to every group that has a pair of it."""
    who = pairs.select("gid", F.col("a").alias("key")).union(pairs.select("gid", F.col("b"))).distinct()
    # the smaller key of a pair carries the list of its partners
    lists = pairs.groupBy("gid", F.least("a", "b").alias("key")).agg(F.collect_set(F.greatest("a", "b")).alias("partners"))
    rows = who.join(lists, ["gid", "key"], "left").join(texts, "key").select("gid", "key", "partners", "text")

    def run(batches):
        def one(t: pa.Table) -> pa.RecordBatch:
            keys = t["key"].to_pylist()
            sets = dict(zip(keys, _sets_of(t, words), strict=True))
            out = []
            for k, partners in zip(keys, t["partners"].to_pylist(), strict=True):
                own = set(sets[k].tolist()) if partners else ()
                for p in partners or ():
                    if len(own.intersection(sets[p].tolist())) >= least_overlap(len(own), len(sets[p]), percent):
                        out.append((k, p))
            return _edges(out)
        yield from _grouped(batches, one)
    return rows.repartition(parts, "gid").sortWithinPartitions("gid").mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their key: itself if it has none yet."""
    if found is None:
        return rows.withColumn("component", F.col("key"))
    return rows.join(found.toDF("key", "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))


def _unlike(rows: DataFrame) -> DataFrame:
    """``rows`` (gram, key) of signatures that several sets have, and of those
    that exactly the same sets have, of one."""
    per = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("key")).alias("f1"),
                                   F.bit_xor(F.xxhash64("key", F.lit(3))).alias("f2")).filter("members > 1")
    one = per.groupBy("members", "f1", "f2").agg(F.min("gram").alias("gram"))
    return rows.join(one.select("gram"), "gram", "left_semi")


def _several(rows: DataFrame) -> DataFrame:
    """``rows`` (gram, key, component) of signatures that are in more than one component."""
    per = rows.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    return rows.join(per.select("gram"), "gram", "left_semi")


def _led(rows: DataFrame, bits: DataFrame, percent: int, r: int) -> DataFrame:
    """a, b: set ``b`` and, of the leaders of its signatures that it may be
    similar to and that are in another component, the one of smallest key."""
    order = F.struct(F.xxhash64("key", F.lit(r)).alias("h"), "key", "component")
    leaders = rows.groupBy("gram").agg(F.min(order).alias("lead")).select("gram", F.col("lead.key").alias("a"), F.col("lead.component").alias("other"))
    pairs = (rows.join(leaders, "gram").filter("component != other").select("a", F.col("key").alias("b")).distinct())
    pairs = (pairs.join(bits.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a")
             .join(bits.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b"))

    def run(b: pa.RecordBatch):
        x, y = b["x"].to_pylist(), b["y"].to_pylist()
        na, nb = b["na"].to_numpy(), b["nb"].to_numpy()
        kind = np.array([[len(v), len(w)] for v, w in zip(x, y, strict=True)], np.int64)
        keep = np.zeros(b.num_rows, bool)
        for lx, ly in np.unique(kind, axis=0).tolist():
            at = np.flatnonzero((kind[:, 0] == lx) & (kind[:, 1] == ly))
            rows_of = [np.frombuffer(b"".join([c[i] for i in at.tolist()]), U).reshape(len(at), -1) for c in (x, y)]
            keep[at] = _may_link(*rows_of, na[at], nb[at], percent)
        yield b.select(["a", "b"]).filter(pa.array(keep))
    return arrow_map(pairs.select("a", "b", "na", "nb", "x", "y"), run, "a long, b long").groupBy("b").agg(F.min("a").alias("a"))


def _placed(led: DataFrame) -> DataFrame:
    """gid, key: who joins whom in a round.  ``led``: a (leader), b."""
    sizes = led.groupBy("a").agg(F.count(F.lit(1)).alias("members"))
    wide = led.join(sizes, "a").withColumn("parts", F.ceil(F.col("members") / GROUP).cast("int"))
    own = F.pmod(F.xxhash64("b", F.lit(7)), F.col("parts")).cast("int")
    # of a split group, about LEADERS documents go into every part, as its leader does
    leads = (F.col("parts") > 1) & (F.pmod(F.xxhash64("b", F.lit(11)), F.col("members")) < LEADERS)
    part = F.explode(F.when(leads, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))).alias("part")
    gid = F.xxhash64("a", "part").alias("gid")
    heads = sizes.select("a", F.explode(F.sequence(F.lit(0), F.ceil(F.col("members") / GROUP).cast("int") - 1)).alias("part"))
    return wide.select("a", "b", part).select(gid, F.col("b").alias("key")).union(heads.select(gid, F.col("a"))).distinct()


def _crowds(rows: DataFrame) -> DataFrame:
    """``rows`` with gid, block, other: groups in which every two sets that share
    a signature meet.  Those of a crowd fall into blocks of half a group, and each
    two blocks are a group."""
    members = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.when(F.col("members") > CROWD, F.ceil(F.col("members") / max(1, GROUP // 2))).otherwise(F.lit(1)).cast("long")
    gid = F.xxhash64("gram", F.least("block", "other"), F.greatest("block", "other"))
    return (rows.join(members, "gram").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key", F.lit(5)), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("gid", gid).drop("members", "blocks"))


def _allowed(t: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row i and the rows j of a group that bitmaps allow to be similar to it, each
    pair of different components once."""
    n, label, block = (t[c].to_numpy() for c in ("n", "component", "block"))
    across = bool((block != t["other"].to_numpy()).any())       # sets of one block meet in their own group
    bits = t["bits"].to_pylist()
    size = np.array([len(x) for x in bits])
    by = {w: np.flatnonzero(size == w) for w in np.unique(size).tolist()}
    maps = {w: np.frombuffer(b"".join([bits[i] for i in at.tolist()]), U).reshape(len(at), -1) for w, at in by.items()}
    for w, at in by.items():
        for v, to in by.items():
            if v < w or 100 * int(n[at].max()) < percent * int(n[to].min()):
                continue
            small = _fold(maps[v], w // 8)
            for k, i in enumerate(at.tolist()):
                near = (label[to] != label[i]) & ((to > i) | (v > w))
                if across:
                    near &= block[to] != block[i]
                near = np.flatnonzero(near)
                if len(near):
                    got = to[near[_may_link(small[near], maps[w][k:k + 1], n[to[near]], n[i], percent)]]
                    if len(got):
                        yield i, got


def _open_rows(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """gram, key: the sets that may be similar to another with that signature, of
    a different component.  ``rows``: gram, key, n, component, bits."""
    def run(batches):
        def one(t: pa.Table) -> pa.RecordBatch:
            some = np.zeros(t.num_rows, bool)
            for i, got in _allowed(t, percent):
                some[i] = some[got] = True
            return _batch(gram=t["gram"].to_numpy()[some], key=t["key"].to_numpy()[some])
        yield from _grouped(batches, one)
    met = _crowds(rows).repartition(parts, "gid").sortWithinPartitions("gid")
    return met.mapInArrow(run, "gram long, key long").distinct()


def _open_pairs(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """a, b, gid: the pairs of ``rows`` (gram, key, n, component, bits) of different
    components that share a signature and may be similar.  Of all groups that a
    pair meets in, that of its smallest signature lists it."""
    lists = rows.groupBy("key").agg(F.collect_list("gram").alias("grams"))

    def run(batches):
        def one(t: pa.Table) -> pa.RecordBatch:
            keys, gram, grams = t["key"].to_pylist(), t["gram"][0].as_py(), t["grams"]
            out = []
            for i, got in _allowed(t, percent):
                own = set(grams[i].as_py())
                out += [(min(keys[i], keys[j]), max(keys[i], keys[j])) for j in got.tolist()
                        if min(own.intersection(grams[j].as_py())) == gram]
            return _edges(out)
        yield from _grouped(batches, one)
    met = _crowds(rows).join(lists, "key").repartition(parts, "gid").sortWithinPartitions("gid")
    return met.mapInArrow(run, "a long, b long").withColumn("gid", F.col("a"))


def _merged(found: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """node, component after ``links`` too.  They are carried to the components
    found so far first, so what is joined up is a few edges between those and not
    all links again."""
    if links.isEmpty():
        return found
    if found is None:
        return components(links)
    for end in ("a", "b"):
        links = links.join(found.toDF(end, "label"), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    higher = components(links)
    moved = found.join(higher.toDF("component", "higher"), "component", "left").select("node", F.coalesce("higher", "component").alias("component"))
    return stage_table(moved.union(higher.join(found, "node", "left_anti").select("node", "component")), "components")


def classes(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """key, n, component of every document.  ``docs``: key (unique), text."""
    spark = docs.sparkSession
    step = StagingScope()
    with use_scope(step):
        sketched = stage_table(sketches(docs, words), "sketches")
    sized = stage_table(sketched.select("key", "n", "f1", "f2"), "sizes")
    equal = sized.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("key").alias("rep"))
    # about 1.9 signatures for each n-gram in which two sets of a size may differ
    marks = 4 * (sized.agg(F.sum("n")).first()[0] or 0) * (100 - percent) // (100 + percent)
    with use_scope(step):
        rows = stage_table(shared_signatures(docs, words, percent, shards(spark, 16 * marks)), "signatures")
        rows = stage_table(_unlike(rows), "signatures")
        # copies have all signatures in common
        rows = rows.join(equal.select(F.col("rep").alias("key")), "key", "left_semi")
    open_rows = stage_table(_labelled(_unlike(rows), None), "open-signatures")
    some = stage_table(open_rows.select("key").distinct(), "sharing")
    bits = stage_table(sketched.select("key", "n", "bits").join(some, "key", "left_semi"), "bits")
    step.drop(spark)
    parts = shards(spark, int(bits.agg(F.sum("n")).first()[0] or 0) * GRAM_BYTES)
    texts = stage_bucketed(docs.join(some, "key", "left_semi"), "shared-texts", "key", parts)
    found = None
    for r in range(ROUNDS):
        led = stage_table(_led(open_rows, bits, percent, r), "led")
        if led.isEmpty():
            break
        placed = _labelled(_placed(led), found)
        links = stage_table(links_in_groups(placed.join(texts, "key"), words, percent, parts), "links")
        found = _merged(found, links)
        before, step = step, StagingScope()
        with use_scope(step):
            open_rows = stage_table(_several(_labelled(open_rows.select("gram", "key"), found)), "open-signatures")
        before.drop(spark)
    near = stage_table(_open_rows(open_rows.join(bits, "key"), percent, parts), "near-signatures")
    pairs = stage_table(_open_pairs(_labelled(near, found).join(bits, "key"), percent, parts), "pairs")
    final = _merged(found, stage_table(links_of_pairs(pairs, texts, words, percent, parts), "links"))
    if final is None:
        final = spark.createDataFrame([], "node long, component long")
    members = sized.join(equal, ["n", "f1", "f2"], "left").select("key", "n", F.coalesce("rep", "key").alias("rep"))
    return (members.join(final.toDF("rep", "component"), "rep", "left")
            .select("key", "n", F.coalesce("component", "rep").alias("component")))


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest id that is
    reachable over links."""
    texts, rows = keyed(docs)
    found = classes(texts, words, percent)
    ids = rows.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return (per_row(found.join(ids, "component"), rows)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))

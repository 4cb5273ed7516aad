"""Hard negatives: the best-scoring rows of other labels inside a score window.

For every anchor its best rows of the same label are its positives; for every
positive the best rows of other labels whose score lies between ``low`` and
``high`` percent of the positive's score are its hard negatives.  Scores are
exact integer inner products.

**Tree.**  Rows are indexed by a multiway hyperplane tree in the manner of a
geometric near-neighbour access tree.  Adding the component
``sqrt(M^2 - |x|^2)`` (``M``: greatest norm) puts all rows on one sphere, where
the distance of an anchor (with 0 added) falls as its score rises: a score
window is an annulus around the anchor.  A node has up to ``ARITY`` split points,
far apart from each other; a row goes to the nearest.  The split points are
chosen from a bounded sample (``SAMPLE`` rows with the smallest hashes), then
every row is sent down the tree by Spark and the leaves are packed, one record
for at most about ``LEAF_ROWS`` rows.  Each split point stores the least and the
greatest distance to the rows of every sibling's subtree, taken over all rows.

**Search.**  Anchors go in blocks of ``BLOCK``; a block is sent to the tasks that
hold the leaves.  By the triangle inequality a split point's range for a subtree
bounds the distances between an anchor and that subtree; where they miss the
annulus of a window, the subtree is passed over.  What is left is scored whole.
Windows narrow as better rows are found, the sample first.  Nothing is skipped
that could be in a result, so results are exact.

A leaf larger than a record (many equal vectors, say) is dealt over several by
row, so no task holds more than a record and the running best of a block.

Rows with a null label, a null vector or a null or non-finite component take no
part.  Shorter vectors are read with zeros at their end.  A null id comes after
all others among ties.  Equal rows are rows of their own; repeated ids too.  A
score beyond 2**62 in size raises.  Empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kollektiv.llm.common import scratch_path, stage_table
from kollektiv.operators.ids import dense_row_number

#: Rows that split points are chosen from, split points of a node, rows of a
#: packed leaf, anchors of a block.
SAMPLE, ARITY, LEAF_ROWS, BLOCK = 4096, 8, 1024, 2048
_NO_ID = (1 << 63) - 1


def quantised(vectors: DataFrame, label: Column, anchor: Column, scale: int = 256,
              id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, label, anchor, vec) of the rows that take part; a component becomes
    ``floor(scale * x)``."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.filter(label.isNotNull() & x.isNotNull()).filter(~bad)
            .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long")).alias("vec")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten())
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Space:
    """Scores and distances.  ``top`` is the greatest squared norm of all rows;
    below 2**53 every partial sum of a product is exact in doubles."""

    def __init__(self, top: int, dim: int):
        self.top, self.dim, self.kind = top, dim, np.float64 if top < 1 << 53 else np.int64
        self.slack = 1e-6 * float(top) ** 0.5 + 1e-9

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(self.kind) @ b.astype(self.kind).T).astype(np.int64)

    def height(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.sqrt(np.maximum(float(self.top) - (x * x).sum(1), 0))

    def between(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of rows to split points, on the sphere."""
        along = rows.astype(np.float64) @ points.astype(np.float64).T
        return np.sqrt(np.maximum(2 * (float(self.top) - along - np.outer(self.height(rows), self.height(points))), 0))

    def reach(self, anchors: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of each anchor at which rows have ``score``."""
        a = anchors.astype(np.float64)
        return np.sqrt(np.maximum((a * a).sum(1) + float(self.top) - 2 * score.astype(np.float64), 0))


class Tree:
    """Split points of all nodes in one matrix.  A node is (first split point,
    number, children); a child is a node's number or ``~leaf``.  ``paths`` has the
    (node, child) steps to each leaf."""

    def __init__(self, space: Space, sample: np.ndarray, leaf_rows: int):
        self.space, self.nodes, self.paths, points = space, [], [], []
        self.ranges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        todo = [(np.arange(len(sample)), None, [])]
        while todo:
            rows, parent, path = todo.pop()
            chosen = self._spread(sample[rows]) if len(rows) > leaf_rows else []
            if len(chosen) < 2:
                here = ~len(self.paths)
                self.paths.append(path)
            else:
                here = len(self.nodes)
                self.nodes.append((sum(map(len, points)), len(chosen), [None] * len(chosen)))
                points.append(sample[rows[chosen]])
                nearest = space.between(sample[rows], points[-1]).argmin(1)
                todo += [(rows[nearest == j], (here, j), [*path, (here, j)]) for j in range(len(chosen))]
            if parent is not None:
                self.nodes[parent[0]][2][parent[1]] = here
        self.points = np.concatenate(points) if points else np.zeros((0, space.dim), np.int64)

    def _spread(self, rows: np.ndarray) -> list[int]:
        """Rows far from each other: each next one is the farthest from those before."""
        chosen = [int(self.space.between(rows, rows[:1])[:, 0].argmax())]
        least = self.space.between(rows, rows[chosen])[:, 0]
        while len(chosen) < ARITY and least.max() > self.space.slack:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, self.space.between(rows, rows[chosen[-1:]])[:, 0])
        return chosen

    def split_points(self, node: int) -> np.ndarray:
        first, n, _ = self.nodes[node]
        return self.points[first:first + n]

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            node, at = todo.pop()
            nearest = self.space.between(rows[at], self.split_points(node)).argmin(1)
            for j, child in enumerate(self.nodes[node][2]):
                mine = at[nearest == j]
                if len(mine) and child < 0:
                    out[mine] = ~child
                elif len(mine):
                    todo.append((child, mine))
        return out

    def bounds(self, leaf: int, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance that a row of the leaf can have from each
        anchor, of which ``away`` has the distances to all split points."""
        low, high = np.zeros(len(away)), np.full(len(away), np.inf)
        for node, child in self.paths[leaf]:
            if (found := self.ranges.get((node, child))) is None:
                continue
            first, n, _ = self.nodes[node]
            d = away[:, first:first + n]
            low = np.maximum(low, np.maximum(found[0] - d, d - found[1]).max(1))
            high = np.minimum(high, (d + found[1]).min(1))
        return low - self.space.slack, high + self.space.slack


class Best:
    """The best ``k`` of each query so far, by score, then id."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.q = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)

    def offer(self, queries: np.ndarray, scores: np.ndarray, valid: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` and ``valid``: a row for each of ``queries``, a column for
        each of ``ids``."""
        none = np.iinfo(np.int64).min
        scores = np.where(valid, scores, none)
        least, n = self.least[queries], scores.shape[1]
        if n > self.k:
            least = np.maximum(least, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
        at, col = np.nonzero(valid & (scores >= least[:, None]))
        if not len(at):
            return
        q = np.concatenate([self.q, queries[at]])
        score, found = np.concatenate([self.score, scores[at, col]]), np.concatenate([self.id, ids[col]])
        order = np.lexsort((found, -score, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = order[rank < self.k]
        full = order[rank == self.k - 1]
        both = np.concatenate([self.q, queries[at]])
        self.q, self.score, self.id = both[keep], score[keep], found[keep]
        np.maximum.at(self.least, both[full], score[full])


class Anchors:
    """A block of anchors: rows, labels, vectors, and where split points lie."""

    def __init__(self, got: pa.Table, space: Space, points: np.ndarray):
        self.row, self.label = (np.asarray(got[c]) for c in ("row", "label"))
        self.id = np.asarray(got["id"].fill_null(_NO_ID))
        self.vec = _matrix(got["vec"], space.dim)
        near = self.vec.astype(np.float64)
        self.away = np.sqrt(np.maximum((near * near).sum(1)[:, None] + float(space.top)
                                       - 2 * near @ points.astype(np.float64).T, 0))


def _score_leaves(tree: Tree, block: Anchors, who: np.ndarray, other: bool, k: int, low: np.ndarray,
                  high: np.ndarray, out: list[tuple[str, np.ndarray]], schema: str):
    """Task function: the best ``k`` rows of each query in the leaves of a task.
    Query q is of anchor ``who[q]`` and takes scores from ``low`` to ``high``, of
    other labels or of the anchor's; ``out`` are columns by query."""
    space = tree.space

    def run(batches):
        best = Best(len(who), k, low)
        for batch in batches:
            for leaf, labels, rows, ids, vec in zip(*(batch.column(c) for c in ("leaf", "labels", "rows", "ids", "vec")), strict=True):
                labels, rows, ids = (np.frombuffer(x.as_py(), np.int64) for x in (labels, rows, ids))
                nearest, farthest = tree.bounds(leaf.as_py(), block.away)
                alive = np.flatnonzero((nearest[who] <= space.reach(block.vec[who], best.least))
                                       & (farthest[who] >= space.reach(block.vec[who], high)))
                if not len(alive):
                    continue
                asked, at = np.unique(who[alive], return_inverse=True)
                vec = np.frombuffer(vec.as_py(), np.int64).reshape(len(ids), space.dim)
                scores = space.scores(block.vec[asked], vec)
                same = labels == block.label[asked][:, None]
                able = ~same if other else same & (rows != block.row[asked][:, None])
                for part in range(0, len(alive), BLOCK):
                    q, a = alive[part:part + BLOCK], at[part:part + BLOCK]
                    s = scores[a]
                    best.offer(q, s, able[a] & (s >= low[q][:, None]) & (s <= high[q][:, None]), ids)
        if len(best.q):
            found = [("id", best.id), ("score", best.score), ("query", best.q), *((n, v[best.q]) for n, v in out)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for _, v in found], names=[n for n, _ in found])

    return run, schema


def _index(rows: DataFrame) -> tuple[Space, Tree, pa.Table, DataFrame] | None:
    """Space, tree with its ranges, the sample, and the packed leaves."""
    norm = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top"), F.max(F.size("vec")).alias("dim")).first()
    if not size.n:
        return None
    if size.top >= 2.0 ** 62:
        raise ValueError("inner products of these vectors can be beyond 2**62")
    space = Space(int(size.top) + 1, size.dim)
    bound = max(ARITY, min(SAMPLE, (64 << 20) // (8 * max(1, size.dim))))
    sample = rows.select("row", "id", "label", "vec").orderBy(F.xxhash64("row"), "row").limit(bound).toArrow()
    points = _matrix(sample["vec"], space.dim)
    tree = Tree(space, points, max(16, len(points) * LEAF_ROWS // size.n))

    def find(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.leaves(_matrix(b.column("vec"), space.dim)))],
                                             names=[*b.schema.names, "leaf"])

    placed = stage_table(rows.select("row", "id", "label", "vec").mapInArrow(
        find, "row long, id long, label long, vec array<long>, leaf long"), "placed")
    # a leaf of many rows is dealt over several records; there are at most as many leaves as sampled rows
    parts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / LEAF_ROWS).alias("parts"))
    dealt = (placed.join(F.broadcast(parts), "leaf")
             .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts"))

    def pack(got: pa.Table) -> pa.Table:
        got = got.sort_by([("id", "ascending"), ("row", "ascending")])
        leaf, vec = got["leaf"][0].as_py(), _matrix(got["vec"], space.dim)
        steps = []
        for node, child in tree.paths[leaf]:
            d = space.between(vec, tree.split_points(node))
            steps += [{"node": node, "child": child, "point": i, "least": x, "most": y}
                      for i, (x, y) in enumerate(zip(d.min(0).tolist(), d.max(0).tolist(), strict=True))]
        columns = [np.asarray(got["label"]), np.asarray(got["row"]), np.asarray(got["id"].fill_null(_NO_ID)), vec]
        return pa.table({"leaf": pa.array([leaf], pa.int64()),
                         **{n: pa.array([np.ascontiguousarray(v, np.int64).tobytes()], pa.binary())
                            for n, v in zip(("labels", "rows", "ids", "vec"), columns, strict=True)},
                         "steps": pa.array([steps], pa.list_(pa.struct({
                             "node": pa.int64(), "child": pa.int64(), "point": pa.int64(),
                             "least": pa.float64(), "most": pa.float64()})))})

    leaves = stage_table(dealt.groupBy("leaf", "part").applyInArrow(
        pack, "leaf long, labels binary, rows binary, ids binary, vec binary,"
              " steps array<struct<node:long,child:long,point:long,least:double,most:double>>"), "leaves")
    ranges = (leaves.select(F.explode("steps").alias("s")).groupBy("s.node", "s.child", "s.point")
              .agg(F.min("s.least").alias("least"), F.max("s.most").alias("most")))
    for r in ranges.collect():          # split points squared of each node, of a bounded sample
        least, most = tree.ranges.setdefault((r.node, r.child), tuple(np.zeros((2, tree.nodes[r.node][1]))))
        least[r.point], most[r.point] = r.least, r.most
    return space, tree, sample, leaves.drop("steps")


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for ``rows`` as ``quantised`` gives them."""
    spark = rows.sparkSession
    rows = stage_table(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    index = _index(rows)
    blocks = -(-rows.filter("anchor").count() // BLOCK)
    if index is None or not blocks:
        return spark.createDataFrame([], RESULT)
    space, tree, sample, leaves = index
    known = {c: np.asarray(sample[c]) for c in ("row", "label")}
    known |= {"id": np.asarray(sample["id"].fill_null(_NO_ID)), "vec": _matrix(sample["vec"], space.dim)}
    top = np.iinfo(np.int64).max // 4
    # a block is a range of the anchors in row order
    asked = stage_table(dense_row_number(rows.filter("anchor").drop("anchor"), [F.col("row").asc()], "number"), "anchors")
    path = scratch_path(spark, "hard-negatives")
    for n in range(blocks):
        block = Anchors(asked.filter((F.col("number") > n * BLOCK) & (F.col("number") <= (n + 1) * BLOCK)).drop("number")
                        .orderBy("row").toArrow(), space, tree.points)
        scores = space.scores(block.vec, known["vec"])
        same = known["label"] == block.label[:, None]
        every = np.arange(len(block.id))

        def kth(scores: np.ndarray, able: np.ndarray, k: int) -> np.ndarray:
            """What the sample's k-th best has; rows below it are in no result."""
            if scores.shape[1] < k:
                return np.full(len(scores), -top)
            return np.partition(np.where(able, scores, -top), -k, axis=1)[:, -k]

        least = kth(scores, same & (known["row"] != block.row[:, None]), positives)
        run, schema = _score_leaves(tree, block, every, False, positives, least, np.full(len(every), top), [],
                                    "id long, score long, query long")
        found = _ranked(leaves.mapInArrow(run, schema), "query", positives).orderBy("query", "rank").toArrow()
        if not found.num_rows:
            continue
        who, score = np.asarray(found["query"]), np.asarray(found["score"])
        window_low, window_high = -((-low * score) // 100), (high * score) // 100
        at_least = window_low.copy()
        for part in range(0, len(who), 256):
            w = slice(part, part + 256)
            s = scores[who[w]]
            able = ~same[who[w]] & (s >= window_low[w][:, None]) & (s <= window_high[w][:, None])
            at_least[w] = np.maximum(at_least[w], kth(s, able, negatives))
        run, schema = _score_leaves(
            tree, block, who, True, negatives, at_least, window_high,
            [("anchor", block.id[who]), ("positive", np.asarray(found["id"])), ("positive_score", score)],
            "id long, score long, query long, anchor long, positive long, positive_score long")
        real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
        (_ranked(leaves.mapInArrow(run, schema), "query", negatives)
         .select(real("anchor").alias("anchor_id"), real("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                 real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(path))
    spark.createDataFrame([], RESULT).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)

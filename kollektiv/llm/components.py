"""Connected components of edges, as joins and aggregations.

Each round hangs every node on its smallest neighbour (or itself), follows
that one step further, and contracts the edges; a star collapses at once and
long chains shrink by a factor each round.  Nothing is collected; each round is
staged in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.llm.common import stage_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge (a, b) to another.  Loops and repeated edges change nothing; edges
    with a null end are ignored; no edges give no rows."""
    edges = stage_table(edges.select("a", "b").filter("a != b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = both.toDF("node", "next").groupBy("node").agg(F.min("next").alias("next"))
        low = low.select("node", F.least("node", "next").alias("parent"))
        up = low.toDF("parent", "grand")
        parents = stage_table(low.join(up, "parent").select("node", F.col("grand").alias("parent")), "parents")
        labels = parents if labels is None else (
            labels.join(parents.toDF("parent", "higher"), "parent", "left")
            .select("node", F.coalesce("higher", "parent").alias("parent")))
        edges = stage_table(
            edges.join(parents.toDF("a", "pa"), "a").join(parents.toDF("b", "pb"), "b")
            .filter("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stage_table(labels.withColumnRenamed("parent", "component"), "components")

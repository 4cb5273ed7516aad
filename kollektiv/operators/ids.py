"""Dense global numbering without a single-partition sort (WIN-1, WIN-2).

``row_number() over (order by k)`` without a partition moves every row to one
task.  Instead:

1. range-partition on the ordering (tiebreak columns included, so a hot
   leading key is still split), sort within partitions, tag each row with
   ``monotonically_increasing_id`` whose upper 31 bits are the partition index;
2. count rows per partition (partial aggregation: one row per partition),
   running-sum those counts (only as many rows as partitions), and join the
   offsets back with a broadcast whose size is bounded by the partition count.

Both steps must see one materialisation of step 1: two scans of the same
lineage may be planned differently (column pruning) and range bounds are
sampled per plan.  Step 1 is therefore written once as a table in the shared
checkpoint folder (``stage_table``), which also survives the loss of
executors.  The partition index travels as a column, so how the staged
table is read back does not matter.

The numbering equals ``row_number()`` exactly (ties apart, which are
unspecified in the reference as well).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kollektiv.session import partitions_for, stage_table

_PART_SHIFT = 33  # monotonically_increasing_id: partition index << 33 | row index


def _partitions(df: DataFrame, n: int | None) -> int:
    """Explicit count if given, else sized from the plan's estimate (the range
    partitions must grow with the data: AQE does not resize them)."""
    return n or partitions_for(df)


M_COL, P_COL = "__kollektiv_m", "__kollektiv_p"


def rank_partitions(df: DataFrame, order_by: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """Step 1 of WIN-1: range-partition, sort within partitions, tag rows with
    ``(partition, position)``, and stage the result (a table in the shared
    checkpoint folder).  The staged frame can also stand in for ``df`` itself
    (``drop(M_COL, P_COL)``), so a pipeline that needs both pays one write."""
    n = _partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order_by)
                .sortWithinPartitions(*order_by)
                .withColumn(M_COL, F.monotonically_increasing_id())
                .withColumn(P_COL, F.shiftright(F.col(M_COL), _PART_SHIFT)))
    return stage_table(ranged, "ranked")


def number_ranked(ranked: DataFrame, name: str = "event_id") -> DataFrame:
    """Step 2 of WIN-1: per-partition counts -> running offsets (one row per
    partition) -> broadcast join -> 1-based dense number ``name``."""
    counts = ranked.groupBy(P_COL).agg(F.count(F.lit(1)).alias("__kollektiv_n"))
    offsets = counts.select(
        P_COL, (F.sum("__kollektiv_n").over(Window.orderBy(P_COL).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__kollektiv_off"))
    offsets = offsets.fillna(0, subset=["__kollektiv_off"])
    out = ranked.join(F.broadcast(offsets), P_COL, "left")
    pos = (F.col("__kollektiv_off") + (F.col(M_COL) - F.shiftleft(F.col(P_COL), _PART_SHIFT)) + 1).cast("bigint")
    return out.withColumn(name, pos).drop(M_COL, P_COL, "__kollektiv_off")


def dense_row_number(df: DataFrame, order_by: Sequence[Column], name: str = "event_id",
                     num_partitions: int | None = None) -> DataFrame:
    """WIN-1: append ``name`` = 1-based position of each row under ``order_by``."""
    return number_ranked(rank_partitions(df, order_by, num_partitions), name)


def positional_id(df: DataFrame, order_by: Sequence[Column], name: str = "id",
                  num_partitions: int | None = None) -> DataFrame:
    """WIN-2: 0-based position under ``order_by`` as text (records without an id)."""
    out = dense_row_number(df, order_by, name="__kollektiv_pos", num_partitions=num_partitions)
    return out.withColumn(name, (F.col("__kollektiv_pos") - 1).cast("string")).drop("__kollektiv_pos")

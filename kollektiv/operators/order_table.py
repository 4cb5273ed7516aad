"""Dense numbering that is maintained, not rebuilt (WIN-1 over a changing table).

``dense_row_number`` sorts every row again whenever one changes.  Here the rows
are kept in ranges of the ordering, each a folder of a versioned table, with
their place inside the range; a small table beside them holds the order
statistics: for each range, in order, its first row and its number of rows.

    event_id of a row = rows in the ranges before its own + its place

A change is a set of rows that leave and a set that come.  Each finds its range
among the first rows; only ranges that got a change are read, sorted and written
again.  All others keep their files, and their rows move up or down with the
running sum.  A range that has grown beyond twice ``RANGE_ROWS`` is cut, an empty
one ends.

* Finding ranges needs no search in Python and no broadcast of bounds: changed
  rows and first rows are sorted together by range partitioning, and a row's range
  is the number of first rows up to it (a sum per partition and a running sum over
  partitions, as in ``operators.ids``).  Any number of changed rows may fall into
  one range.
* Data, statistics and the version of the source that they hold are published by
  one manifest (``sinks.versions``); a second writer gets ``Conflict``.
* Rows must be distinct, which replace-on-key sees to.  A change that would leave
  or find equal rows raises ``ValueError`` and publishes nothing.
* Defined cases: nulls sort last; an empty table has no ranges and grows by the
  first change; a change without rows publishes only the new notes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kollektiv.operators.ids import M_COL, P_COL, dense_row_number, rank_partitions
from kollektiv.session import stage_table, staging_scope
from kollektiv.sinks import versions

#: Rows of a range when it is cut.
RANGE_ROWS = 1 << 22
#: Rows that a task sorts; the number of tasks follows the counted rows.
TASK_ROWS = 1 << 19
#: Ranges whose statistics may be broadcast (24 bytes each).
BROADCAST_RANGES = 1_000_000

RANGE, PLACE = "range_id", "range_place"
_N, _ORDINAL, _G, _SIGN, _PIECE = "__range_n", "__range_ordinal", "__range_g", "__range_sign", "__range_piece"


@dataclass(frozen=True)
class Change:
    """What a change did: ranges written again, ranges in all, rows in them."""
    version: int
    ranges_written: int
    ranges: int
    rows_written: int


def _order(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _full_order(df: DataFrame, order: tuple[str, ...]) -> list[str]:
    return [*order, *[c for c in df.columns if c not in order]]


def _statistics(spark: SparkSession, path: str, found: dict) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{found['attached'][0]}")


def _publish(placed: DataFrame, pieces: DataFrame, path: str, gone: list[str], notes: dict, expect: int) -> dict:
    """``placed`` rows become their ranges; ``pieces`` (one row per range of the
    whole table, unnumbered order in ``_ORDINAL, _PIECE``) become the statistics."""
    folder = f"{versions.DATA}/ranges-{uuid.uuid4().hex[:16]}"
    by_order = Window.orderBy(_ORDINAL, _PIECE)                    # one row per range
    before = F.coalesce(F.sum(_N).over(by_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    (pieces.withColumn("rows_before", before.cast("long")).withColumn("ordinal", F.row_number().over(by_order).cast("long"))
     .drop(_ORDINAL, _PIECE).coalesce(1).write.parquet(f"{path.rstrip('/')}/{folder}"))
    return versions.replace_days(placed, path, RANGE, lambda rows, f: rows.write.partitionBy(RANGE).parquet(f),
                                 gone=gone, attached=[folder], notes=notes, expect=expect)


def build(df: DataFrame, path: str, order: tuple[str, ...], notes: dict | None = None, expect: int | None = None) -> Change:
    """Number all of ``df`` (ordered by ``order``, then by the other columns).  It
    is counted first: stage it if it is dear."""
    spark, names = df.sparkSession, _full_order(df, order)
    found = versions.current(spark, path)
    with staging_scope(spark):
        zero = F.col(_G) - 1
        placed = (dense_row_number(df, _order(names), _G, _tasks(df.count()))
                  .withColumn(RANGE, F.floor(zero / RANGE_ROWS).cast("long"))
                  .withColumn(PLACE, (zero % RANGE_ROWS + 1).cast("long")).drop(_G))
        placed = stage_table(placed, "placed")
        sizes = placed.groupBy(RANGE).agg(F.count(F.lit(1)).alias(_N))
        pieces = stage_table(placed.filter(F.col(PLACE) == 1).drop(PLACE).join(sizes, RANGE)
                             .withColumn(_ORDINAL, F.col(RANGE)).withColumn(_PIECE, F.lit(0).cast("long")), "range-pieces")
        ids = [str(r[0]) for r in pieces.select(RANGE).collect()]           # one number per range
        gone = sorted(set(found["folders"]) - set(ids)) if found else []
        made = _publish(placed, pieces, path, gone, notes or {},
                        (found["version"] if found else 0) if expect is None else expect)
        return Change(made["version"], len(ids), len(ids), placed.count())


def _ranges_of(changes: DataFrame, stats: DataFrame, names: list[str]) -> DataFrame:
    """``changes`` with the ordinal of the range each row belongs to: the number
    of first rows up to it, at least 1."""
    both = (stats.select(*names).withColumn(_SIGN, F.lit(0))
            .unionByName(changes.select(*names, _SIGN)))
    is_first = (F.col(_SIGN) == 0).cast("long")
    # a first row that leaves belongs to its range: it comes before equal rows of the change
    ranked = rank_partitions(both, [*_order(names), (F.col(_SIGN) != 0).asc()], _tasks(both.count()))
    upto = F.sum(is_first).over(Window.partitionBy(P_COL).orderBy(M_COL).rowsBetween(Window.unboundedPreceding, 0))
    per_part = ranked.groupBy(P_COL).agg(F.sum(is_first).alias("firsts"))
    parts = Window.orderBy(P_COL).rowsBetween(Window.unboundedPreceding, -1)         # one row per partition
    carried = per_part.select(F.col(P_COL).alias("part"), F.coalesce(F.sum("firsts").over(parts), F.lit(0)).alias("carried"))
    return (ranked.withColumn("upto", upto).filter(F.col(_SIGN) != 0)
            .join(F.broadcast(carried), F.col(P_COL) == F.col("part"))
            .withColumn(_ORDINAL, F.greatest(F.lit(1), F.col("carried") + F.col("upto")).cast("long"))
            .select(*names, _SIGN, _ORDINAL))


def change(spark: SparkSession, path: str, leaving: DataFrame, coming: DataFrame, order: tuple[str, ...],
           notes: dict | None = None) -> Change:
    """Rows of ``leaving`` end, rows of ``coming`` are added; numbers are those of
    a full renumbering afterwards."""
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"{path} holds no numbered table")
    expect, stats = found["version"], _statistics(spark, path, found)
    names = _full_order(coming, order)
    with staging_scope(spark):
        changes = stage_table(leaving.select(*names).withColumn(_SIGN, F.lit(-1))
                              .unionByName(coming.select(*names).withColumn(_SIGN, F.lit(1))), "changes")
        n_ranges = len(found["folders"])
        if not n_ranges:
            if changes.filter(F.col(_SIGN) < 0).limit(1).count():
                raise ValueError(f"{path}: rows to leave that the table does not hold")
            return build(coming.select(*names), path, order, notes, expect)
        tagged = stage_table(_ranges_of(changes, stats, names).join(
            _small(stats.select(F.col("ordinal").alias(_ORDINAL), RANGE)), _ORDINAL), "tagged")
        due = {r[RANGE]: (r.less, r.more) for r in tagged.groupBy(RANGE).agg(        # one row per changed range
            F.sum((F.col(_SIGN) < 0).cast("long")).alias("less"), F.sum((F.col(_SIGN) > 0).cast("long")).alias("more")).collect()}
        touched = [str(r) for r in due]
        held = stats.join(F.broadcast(tagged.select(RANGE).distinct()) if len(due) <= BROADCAST_RANGES
                          else tagged.select(RANGE).distinct(), RANGE, "left_semi").agg(F.sum(_N)).first()[0] or 0
        wanted = held + sum(more - less for less, more in due.values())
        where = stats.select(RANGE, F.col("ordinal").alias(_ORDINAL))
        old = range_rows(spark, path, found, touched).drop(PLACE).select(*names, RANGE)
        left = old.exceptAll(tagged.filter(F.col(_SIGN) < 0).select(*names, RANGE))
        rows = left.unionByName(tagged.filter(F.col(_SIGN) > 0).select(*names, RANGE)).join(_small(where), RANGE)
        numbered = stage_table(dense_row_number(rows, [F.col(_ORDINAL).asc(), *_order(names)], _G, _tasks(wanted)), "renumbered")
        sizes = numbered.groupBy(RANGE).agg(F.count(F.lit(1)).alias(_N), F.min(_G).alias("first_g"))
        sizes = stage_table(sizes, "range-sizes")
        if (sizes.agg(F.sum(_N)).first()[0] or 0) != wanted:
            raise ValueError(f"{path}: rows to leave that the table does not hold")
        _refuse_equal_rows(numbered, names)
        at = F.col(_G) - F.col("first_g")
        piece = F.when(F.col(_N) > 2 * RANGE_ROWS, F.floor(at / RANGE_ROWS)).otherwise(F.lit(0)).cast("long")
        placed = (numbered.join(_small(sizes), RANGE).withColumn(_PIECE, piece)
                  .withColumn(PLACE, (at - F.col(_PIECE) * RANGE_ROWS + 1).cast("long")).drop(_G, _N, "first_g"))
        # a range that was cut keeps its id for the first piece; the others get new ones
        last_id = stats.agg(F.max(RANGE)).first()[0]
        cut = placed.groupBy(RANGE, _ORDINAL, _PIECE).agg(F.count(F.lit(1)).alias(_N))
        fresh = F.row_number().over(Window.partitionBy(F.col(_PIECE) == 0).orderBy(_ORDINAL, _PIECE)) + F.lit(last_id)
        cut = stage_table(cut.withColumn("new_id", F.when(F.col(_PIECE) == 0, F.col(RANGE)).otherwise(fresh).cast("long")), "cut")
        ids = _small(cut.select(RANGE, _PIECE, "new_id", _N))
        placed = stage_table(placed.join(ids, [RANGE, _PIECE]).drop(RANGE).withColumnRenamed("new_id", RANGE), "placed")
        pieces = placed.filter(F.col(PLACE) == 1).select(*names, RANGE, _N, _ORDINAL, _PIECE)
        others = (stats.join(_small(tagged.select(RANGE).distinct()), RANGE, "left_anti")
                  .select(*names, RANGE, _N, F.col("ordinal").alias(_ORDINAL), F.lit(0).cast("long").alias(_PIECE)))
        pieces = stage_table(others.unionByName(pieces), "range-pieces")
        written = {str(r[0]) for r in cut.select("new_id").collect()}                # one number per changed range
        made = _publish(placed.select(*names, RANGE, PLACE), pieces, path, sorted(set(touched) - written),
                        notes or {}, expect)
        return Change(made["version"], len(written), len(made["folders"]), wanted)


def _refuse_equal_rows(numbered: DataFrame, names: list[str]) -> None:
    alike = numbered.groupBy(F.xxhash64(*names).alias("a"), F.hash(*names).alias("b")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if alike.limit(1).count():
        suspects = numbered.join(alike, (F.xxhash64(*names) == F.col("a")) & (F.hash(*names) == F.col("b")), "left_semi")
        if suspects.groupBy(*names).count().filter("count > 1").limit(1).count():
            raise ValueError("a numbered table holds distinct rows")


def _small(per_range: DataFrame) -> DataFrame:
    """Per-range rows, broadcast once counted, else left to a shuffled join."""
    return F.broadcast(per_range) if per_range.count() <= BROADCAST_RANGES else per_range


def range_rows(spark: SparkSession, path: str, found: dict, ranges: list[str]) -> DataFrame:
    """Rows of the given ranges; no folder of another range is listed or read."""
    return versions.read(spark, path, version=found["version"], only=ranges)


def read(spark: SparkSession, path: str, name: str = "event_id") -> DataFrame:
    """All rows with their number ``name``: no sort and no shuffle, one small
    table of running sums is broadcast."""
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"{path} holds no numbered table")
    sums = _small(_statistics(spark, path, found).select(RANGE, "rows_before"))
    rows = versions.read(spark, path, version=found["version"])
    return (rows.join(sums, RANGE).withColumn(name, F.col("rows_before") + F.col(PLACE)).drop(RANGE, PLACE, "rows_before"))

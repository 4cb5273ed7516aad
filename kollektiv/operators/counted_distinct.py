"""DISTINCT that is maintained by counting (AGG-1, AGG-2 over a changing table).

A versioned table holds each distinct row with its support: the number of rows of
the input that are it.  When days of the input are replaced, the rows they had are
counted down and the rows they have now are counted up.  A row whose support
becomes 0 ends.  Rows lie in buckets by their hash; only buckets with a support
that changed are read and written again, and a day that is replaced by itself
changes none.

Both sides of a change are aggregated by task before they are shuffled, so a row
that makes up most of the input costs one row per task.

Defined cases: nulls are values; equal rows count each time; an empty input gives
an empty table; a change that takes away more than there is raises ``ValueError``
and publishes nothing; a second writer gets ``versions.Conflict``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv.session import stage_table, staging_scope
from kollektiv.sinks import versions

#: Distinct rows of a bucket when the table is built.
BUCKET_ROWS = 1 << 20
BUCKET, SUPPORT = "support_bucket", "row_support"


@dataclass(frozen=True)
class Change:
    """What a change did: supports that differ, buckets written again, buckets in all."""
    version: int
    rows_changed: int
    buckets_written: int
    buckets: int


def _supports(df: DataFrame, names: list[str], weight) -> DataFrame:
    return df.groupBy(*names).agg(F.sum(weight).cast("long").alias(SUPPORT))


def _write(rows: DataFrame, folder: str) -> None:
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)


def _bucket(names: list[str], buckets: int):
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("long")


def build(df: DataFrame, path: str, notes: dict | None = None) -> Change:
    """Count all of ``df``."""
    spark, names = df.sparkSession, df.columns
    found = versions.current(spark, path)
    with staging_scope(spark):
        counted = stage_table(_supports(df, names, F.lit(1)), "supports")
        n = counted.count()
        buckets = max(1, -(-n // BUCKET_ROWS))
        counted = counted.withColumn(BUCKET, _bucket(names, buckets))
        have = {str(r[0]) for r in counted.select(BUCKET).distinct().collect()}           # one number per bucket
        made = versions.replace_days(counted, path, BUCKET, _write, gone=sorted(set(found["folders"]) - have) if found else [],
                                     notes={**(notes or {}), "buckets": buckets}, expect=found["version"] if found else 0)
        return Change(made["version"], n, len(have), len(made["folders"]))


def change(spark: SparkSession, path: str, leaving: DataFrame, coming: DataFrame, notes: dict | None = None) -> Change:
    """``leaving`` rows are taken out of the input, ``coming`` rows are added."""
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"{path} holds no counted table")
    names, buckets, sign = coming.columns, found["notes"]["buckets"], "__support_sign"
    with staging_scope(spark):
        both = leaving.select(*names).withColumn(sign, F.lit(-1)).unionByName(coming.withColumn(sign, F.lit(1)))
        delta = stage_table(_supports(both, names, F.col(sign)).filter(F.col(SUPPORT) != 0), "support-changes")
        touched = [str(r[0]) for r in delta.select(_bucket(names, buckets)).distinct().collect()]   # one number per bucket
        old = versions.read(spark, path, version=found["version"], only=touched).select(*names, SUPPORT)
        now = stage_table(_supports(old.unionByName(delta.select(*names, SUPPORT)), names, F.col(SUPPORT))
                          .withColumn(BUCKET, _bucket(names, buckets)), "supports")
        if now.filter(F.col(SUPPORT) < 0).limit(1).count():
            raise ValueError(f"{path}: rows to leave that were never counted")
        now = now.filter(F.col(SUPPORT) > 0)
        have = {str(r[0]) for r in now.select(BUCKET).distinct().collect()}
        made = versions.replace_days(now, path, BUCKET, _write, gone=sorted(set(touched) - have),
                                     notes={**(notes or {}), "buckets": buckets}, expect=found["version"])
        return Change(made["version"], delta.count(), len(have), len(made["folders"]))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The distinct rows: a scan, no shuffle."""
    rows = versions.read(spark, path)
    if rows is None:
        raise ValueError(f"{path} holds no counted table")
    return rows.drop(SUPPORT, BUCKET)

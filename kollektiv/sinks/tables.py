"""Table sinks on Parquet folders (a shared file system or object store)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kollektiv.schemas import PARTITION_COLUMN
from kollektiv.sinks import versions

__all__ = ["append_bronze", "overwrite_partitions", "publish_view", "publish_table", "read_table"]


def _prepare(df: DataFrame, sort_key: Sequence[str] | None, rebalance_on: str | None = None) -> DataFrame:
    # ``rebalance``: AQE clusters each day's rows into a few reasonably sized
    # files (no tasks x days small files on a backfill) and splits a hot day.
    if rebalance_on:
        df = df.hint("rebalance", rebalance_on)
    # Sorted within each file on the key: Parquet min/max statistics then skip
    # row groups for key lookups, like the reference's ORDER BY storage key.
    return df.sortWithinPartitions(*sort_key) if sort_key else df


def append_bronze(df: DataFrame, path: str, sort_key: Sequence[str] | None = None,
                  partition_column: str = PARTITION_COLUMN, rebalance: bool = False) -> None:
    """SNK-1: append to a day-partitioned bronze table.  Readers de-duplicate
    with replace-on-key (AGG-6), so a re-run only adds rows.  By default no
    shuffle: a run carries one day, each task writes one file."""
    (_prepare(df, sort_key, partition_column if rebalance else None)
     .write.mode("append").partitionBy(partition_column).parquet(path))


def overwrite_partitions(df: DataFrame, path: str, sort_key: Sequence[str] | None = None,
                         partition_column: str = PARTITION_COLUMN, rebalance: bool = True, gone: Sequence = ()) -> None:
    """SNK-2: replace exactly the day partitions present in ``df``; other days
    are untouched, those in ``gone`` end.  The new files are written beside the old ones and
    published by one manifest (``sinks.versions``), so readers see all days of a
    load or none.  ``rebalance`` (default) keeps a multi-day backfill from
    writing one small file per task and day."""
    def write(rows: DataFrame, folder: str) -> None:
        (_prepare(rows, sort_key, partition_column if rebalance else None).write
         .partitionBy(partition_column).parquet(folder))
    versions.replace_days(df, path, partition_column, write, [str(d) for d in gone])


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """SNK-3: publish a model as a (temporary) view; Catalyst inlines it."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(df: DataFrame, path: str) -> None:
    """SNK-4: rebuild a gold table.  The new version is written completely to a
    folder of its own and published by one manifest; a failed build leaves the
    table as it was, and a model may read the table it replaces."""
    versions.publish(df, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-13: scan a table with its declared schema (no inference; the
    partition column keeps its declared type): the newest version of a versioned
    table, else the files of the folder."""
    found = versions.read(spark, path, schema)
    if found is not None:
        return found
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


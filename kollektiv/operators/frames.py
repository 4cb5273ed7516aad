"""Frame shaping: union by name (SET-1), missing-column back-fill (PRJ-4),
run envelope (PRJ-3, SCL-12)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kollektiv.functions.scalars import run_clock
from kollektiv.operators.ids import positional_id


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: union of frames with differing columns; duplicates kept, missing -> null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def backfill_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ-4: add every column of ``schema`` the frame lacks, as a typed null,
    and return the columns in schema order (extra columns are kept after them)."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    out = df.withColumns(missing) if missing else df
    names = [f.name for f in schema.fields]
    return out.select(*names, *[c for c in out.columns if c not in names])


def ensure_id(df: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """PRJ-4 id rule: keep ``id``; else copy ``ID``; else a positional id (WIN-2)."""
    if "id" in df.columns:
        return df
    if "ID" in df.columns:
        return df.withColumn("id", F.col("ID").cast("string"))
    return positional_id(df, order_by or [F.col(c).asc_nulls_last() for c in df.columns], name="id")


def ensure_version(df: DataFrame) -> DataFrame:
    return df if "version" in df.columns else df.withColumn("version", F.lit(None).cast("string"))


def add_envelope(df: DataFrame, dataset: str, ingestion_ts: _dt.datetime,
                 ingestion_date: _dt.date | str) -> DataFrame:
    """PRJ-3: constant ``dataset`` plus the run clock columns."""
    return df.withColumns({"dataset": F.lit(dataset), **run_clock(ingestion_ts, ingestion_date)})

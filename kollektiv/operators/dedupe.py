"""De-duplication operators: AGG-3 (latest version), AGG-4 (whole row), AGG-6 (replace-on-key).

All three keep one row per group.  They are written as ``row_number() = 1`` over
a window so Catalyst plans a ``WindowGroupLimit`` on *both* sides of the shuffle:
each map task keeps only its best row per key before anything is exchanged,
which is the map-side combine that keeps a hot key (a third of all rows) from
landing in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kollektiv.schemas import PARTITION_COLUMN, VERSION_COLUMN


def _tiebreak(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """D2: a total order over the remaining columns, greatest first, so reruns agree."""
    return [F.col(c).desc_nulls_last() for c in df.columns if c not in set(exclude)]


def keep_first(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``partition_by`` group under ``order_by``."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    rn = "__kollektiv_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def latest_version(df: DataFrame, key: str = "id", version: str = "version",
                   tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """AGG-3: per ``key`` keep the greatest ``version``, compared **as text**
    (``'9' > '10'``), nulls last.  Null keys form one group.  Ties: ``tiebreak``
    if given, else the remaining columns, greatest first.
    """
    order = [F.col(version).desc_nulls_last()]
    order += list(tiebreak) if tiebreak is not None else _tiebreak(df, [key, version])
    return keep_first(df, [key], order)


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """AGG-4: whole-row duplicate removal (partial + final hash aggregate)."""
    return df.dropDuplicates()


def latest_per_key(df: DataFrame, key: Sequence[str], version: str = VERSION_COLUMN,
                   partition_column: str | None = PARTITION_COLUMN,
                   tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """AGG-6 replace-on-key: per ingestion partition and key, the row with the
    greatest ``version`` survives.  Never merges across partitions.

    Write this *before* any filter on a non-key column: such a filter must not
    move below the choice of the surviving row.
    """
    groups = ([partition_column] if partition_column else []) + list(key)
    order = [F.col(version).desc_nulls_last()]
    order += list(tiebreak) if tiebreak is not None else _tiebreak(df, groups + [version])
    return keep_first(df, groups, order)

"""Data-quality operators: profiles (AGG-5, AGG-7), load gates (DQ-1, DQ-2)
and declarative column tests (DQ-3, DQ-4).

Profiles are single aggregations returning one small row; only that row is
ever brought to the driver, to decide whether a gate passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value that must equal the reference's: fail when strictly more than
# this share (in percent) of ActualArrivalTime is null.
NULL_RATE_CEILING_PCT = 50.0


class DataQualityError(ValueError):
    """Raised by a gate; nothing has been written when it is raised."""


def null_rate(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """AGG-7: ``null_count``, ``total_count`` and ``null_pct`` (0 when empty)."""
    nulls = F.count_if(F.col(column).isNull())
    total = F.count(F.lit(1))
    pct = F.coalesce(nulls.cast("double") * 100.0 / F.nullif(total, F.lit(0)), F.lit(0.0))
    aggs = [nulls.cast("bigint").alias("null_count"), total.cast("bigint").alias("total_count"),
            pct.alias("null_pct")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def passes_null_rate(column: str, ceiling_pct: float = NULL_RATE_CEILING_PCT):
    """Column predicate for a ``null_rate`` row: True when the gate passes."""
    return F.col("null_pct") <= F.lit(ceiling_pct)


def gate_null_rate(df: DataFrame, column: str = "ActualArrivalTime",
                   ceiling_pct: float = NULL_RATE_CEILING_PCT) -> dict:
    """DQ-1: raise when strictly more than ``ceiling_pct`` % of ``column`` is null."""
    row = null_rate(df, column).first()
    stats = row.asDict() if row else {"null_count": 0, "total_count": 0, "null_pct": 0.0}
    if stats["null_pct"] > ceiling_pct:
        raise DataQualityError(
            f"Data quality check failed: {stats['null_count']}/{stats['total_count']} "
            f"({stats['null_pct']:.2f}%) of '{column}' values are NULL.")
    return stats


def key_profile(df: DataFrame, key: str = "id") -> DataFrame:
    """AGG-5: ``total_count``, ``null_ids`` and ``duplicate_ids`` (rows after the
    first per key; null ids count as one key, as in pandas ``duplicated``).

    Two-level aggregation: per key counts (partial aggregation before the
    shuffle), then one global sum.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_ids"),
    )


def gate_keys(df: DataFrame, key: str = "id", what: str = "netex_lines") -> dict:
    """DQ-2: any null id, or any duplicate id, fails the run."""
    stats = key_profile(df, key).first().asDict()
    if stats["null_ids"] > 0:
        raise DataQualityError(f"Data quality check failed: {stats['null_ids']} null ids in {what}.")
    if stats["duplicate_ids"] > 0:
        raise DataQualityError(f"Data quality check failed: {stats['duplicate_ids']} duplicate ids in {what}.")
    return stats


def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-3: one pass over the table for all columns -> (column_name, failures)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, failures)")


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """DQ-4: values of ``column`` that occur more than once (nulls are not duplicates)."""
    return (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
              .filter(F.col("n_records") > 1))


# Fixed values that must equal the reference's: the declared column tests
# (model, column, test), in the order they are declared.
DECLARED_TESTS = (
    ("fact_movements", "event_id", "unique"),
    ("fact_movements", "event_id", "not_null"),
    ("fact_movements", "service_journey_id", "not_null"),
    ("fact_movements", "quay_id", "not_null"),
    ("dim_line", "line_id", "unique"),
    ("dim_line", "line_id", "not_null"),
    ("dim_quay", "quay_id", "unique"),
    ("dim_quay", "quay_id", "not_null"),
    ("dim_service_journey", "service_journey_id", "unique"),
    ("dim_service_journey", "service_journey_id", "not_null"),
    ("silver_timetable", "ServiceJourneyId", "not_null"),
    ("silver_timetable", "QuayId", "not_null"),
    ("silver_timetable", "LineId", "not_null"),
    ("silver_timetable", "Ingestion_Date", "not_null"),
    ("silver_lines", "LineId", "unique"),
    ("silver_lines", "LineId", "not_null"),
    ("silver_lines", "Ingestion_Date", "not_null"),
)


def run_column_tests(models: dict[str, DataFrame], tests=DECLARED_TESTS) -> DataFrame:
    """DQ-3/DQ-4 as a test run: one row per declared test
    ``(model, column_name, test, status, failures)``.

    ``failures`` counts null rows (not_null) or duplicated values (unique).
    A test on a column the model does not have reports ``error`` (the
    declared names and the model's columns disagree in places).  Per table,
    all not_null tests share one aggregation pass; each unique test is one
    grouped aggregation (partial aggregation before its shuffle).
    """
    spark = next(iter(models.values())).sparkSession
    parts: list[DataFrame] = []
    by_model: dict[str, list] = {}
    for model, column, test in tests:
        by_model.setdefault(model, []).append((column, test))
    for model, col_tests in by_model.items():
        df = models[model]
        present = [(c, t) for c, t in col_tests if c in df.columns]
        missing = [(c, t) for c, t in col_tests if c not in df.columns]
        nn = [c for c, t in present if t == "not_null"]
        if nn:
            parts.append(not_null_failures(df, nn).select(
                F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures"))
        for c, t in present:
            if t == "unique":
                parts.append(unique_failures(df.select(c), c).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit("unique").alias("test"),
                    F.col("failures").cast("bigint")))
        if missing:
            parts.append(spark.createDataFrame(
                [(model, c, t, None) for c, t in missing],
                "model string, column_name string, test string, failures bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures").isNull(), F.lit("error"))
              .when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))
    return out.select("model", "column_name", "test", status.alias("status"), "failures")

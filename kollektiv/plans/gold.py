"""Gold star schema (MDL-6..9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.functions.scalars import service_date
from kollektiv.operators.dedupe import keep_first
from kollektiv.operators.ids import M_COL, P_COL, dense_row_number, number_ranked, rank_partitions

FACT_ORDER = ("ServiceJourneyId", "QuayId", "AimedArrivalTime")


def dim_line(silver_lines_df: DataFrame, latest_only: bool = False) -> DataFrame:
    """MDL-6: line dimension.  Default keeps one row per line per ingestion day
    (parity, Q3); ``latest_only`` keeps the newest day's row per line (D9)."""
    src = silver_lines_df
    if latest_only:
        src = keep_first(src, ["id"], [F.col("Ingestion_Date").desc_nulls_last(),
                                       *[F.col(c).desc_nulls_last() for c in
                                         ("name", "public_code", "route_id", "direction")]])
    return src.select(F.col("id").alias("line_id"), "name", "public_code", "route_id", "direction")


def dim_quay(stg_quays: DataFrame, silver_timetable_df: DataFrame) -> DataFrame:
    """MDL-7 (JOI-1 + AGG-1): quays left-joined to the stop points seen in the
    timetable.  The right side is reduced to its distinct (QuayId, StopPointId)
    pairs *before* the join — the result is the same (the outer DISTINCT covers
    it) but the join no longer fans out once per movement.  Unmatched quays get
    ``''`` as stop point (the reference engine's default for a missing string).
    """
    right = (silver_timetable_df.select(F.col("QuayId").alias("__quay"), "StopPointId")
             .distinct())
    q = stg_quays.filter(F.col("QuayId").isNotNull())
    joined = q.join(right, q["QuayId"] == right["__quay"], "left")
    return joined.select(
        F.col("QuayId").alias("quay_id"),
        F.coalesce(F.col("StopPointId"), F.lit("")).alias("stop_point_id"),
        F.col("QuayName").alias("quay_name"),
        F.col("Location").alias("location"),
        F.col("ParentStopPointId").alias("parent_stop_point_id"),
    ).distinct()


def quay_stops(silver_timetable_df: DataFrame) -> DataFrame:
    """What ``dim_quay`` takes from the timetable, not yet distinct."""
    return silver_timetable_df.select("QuayId", "StopPointId")


def dim_service_journey(silver_timetable_df: DataFrame, zone: str | None = None) -> DataFrame:
    """MDL-8: distinct (journey, day, direction, mode, line, route)."""
    return journeys(silver_timetable_df, zone).distinct()


def journeys(silver_timetable_df: DataFrame, zone: str | None = None) -> DataFrame:
    """The rows of ``dim_service_journey``, not yet distinct."""
    return (silver_timetable_df.filter(F.col("ServiceJourneyId").isNotNull())
            .select(F.col("ServiceJourneyId").alias("service_journey_id"),
                    service_date("AimedArrivalTime", zone).alias("date_id"),
                    F.col("DirectionRef").alias("direction"),
                    "VehicleMode",
                    F.col("LineId").alias("line_id"),
                    F.col("RouteId").alias("route_id")))


def fact_order_columns(df: DataFrame):
    """WIN-1 ordering (nulls last, as the reference engine sorts) plus a total
    tiebreak over the remaining columns (D2)."""
    head = [F.col(c).asc_nulls_last() for c in FACT_ORDER]
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in FACT_ORDER]
    return head + rest


def fact_movements(silver_timetable_df: DataFrame, zone: str | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """MDL-9: numbered movements (dense ``event_id``, no single-partition sort)."""
    numbered = dense_row_number(silver_timetable_df, fact_order_columns(silver_timetable_df),
                                name="event_id", num_partitions=num_partitions)
    return _fact_columns(numbered, zone)


def rank_timetable(silver_timetable_df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Stage the silver timetable in fact order (step 1 of the numbering).
    ``drop(M_COL, P_COL)`` of the result is the silver timetable itself."""
    return rank_partitions(silver_timetable_df, fact_order_columns(silver_timetable_df), num_partitions)


def fact_movements_from_ranked(ranked: DataFrame, zone: str | None = None) -> DataFrame:
    """MDL-9 over a frame staged by ``rank_timetable``."""
    return _fact_columns(number_ranked(ranked, "event_id"), zone)


def fact_movements_from_numbered(numbered: DataFrame, zone: str | None = None) -> DataFrame:
    """MDL-9 over a maintained numbering (``operators.order_table``)."""
    return _fact_columns(numbered, zone)


def _fact_columns(numbered: DataFrame, zone: str | None) -> DataFrame:
    return numbered.select(
        "event_id",
        F.col("ServiceJourneyId").alias("service_journey_id"),
        F.col("QuayId").alias("quay_id"),
        F.col("StopPointId").alias("stop_point_id"),
        service_date("AimedArrivalTime", zone).alias("date_id"),
        F.col("LineId").alias("line_id"),
        F.col("RouteId").alias("route_id"),
        F.col("DirectionRef").alias("direction"),
        "VehicleMode", "AimedArrivalTime", "ActualArrivalTime", "AimedDepartureTime",
        "ActualDepartureTime", "ArrivalStatus", "DepartureStatus", "Cancellation",
        "DepartureBoardingActivity", "Ingestion_Date",
    )


__all__ = ["dim_line", "dim_quay", "dim_service_journey", "fact_movements", "rank_timetable",
           "fact_movements_from_ranked", "fact_movements_from_numbered", "M_COL", "P_COL"]

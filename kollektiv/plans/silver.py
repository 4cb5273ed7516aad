"""Silver models (MDL-4, MDL-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.functions.scalars import service_date
from kollektiv.schemas import TIMETABLE_COLUMNS


def silver_timetable(stg_live: DataFrame, zone: str | None = None) -> DataFrame:
    """MDL-4: calls that really arrived; DateId re-derived from AimedArrivalTime
    (in UTC unless ``zone`` asks for local days, Q9)."""
    cols = [service_date("AimedArrivalTime", zone).alias("DateId") if c == "DateId" else F.col(c)
            for c in TIMETABLE_COLUMNS]
    return stg_live.filter(F.col("ActualArrivalTime").isNotNull()).select(*cols)


def silver_lines(stg_lines: DataFrame) -> DataFrame:
    """MDL-5: one row per distinct line description per ingestion day (AGG-2)."""
    return stg_lines.select("id", "name", "public_code", "route_id", "direction",
                            "Ingestion_Date").distinct()

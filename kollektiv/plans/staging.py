"""Staging models (MDL-1..3): bronze -> typed, latest-per-key views.

Every bronze read goes through replace-on-key (AGG-6) first (D2), so results
never depend on when a storage engine would have merged duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kollektiv.functions.scalars import json_extract_string, location_text
from kollektiv.operators.dedupe import latest_per_key
from kollektiv.schemas import BRONZE_LIVE_KEY, BRONZE_NETEX_KEY, TIMETABLE_COLUMNS


def stg_live_timetable(bronze_live: DataFrame) -> DataFrame:
    """MDL-1: latest row per (day, journey, quay, date); 17 columns; key not null."""
    latest = latest_per_key(bronze_live, BRONZE_LIVE_KEY)
    return latest.select(*TIMETABLE_COLUMNS).filter(F.col("ServiceJourneyId").isNotNull())


def stg_netex_lines(bronze_lines: DataFrame) -> DataFrame:
    """MDL-2: line attributes out of the JSON payload."""
    latest = latest_per_key(bronze_lines, BRONZE_NETEX_KEY)
    return (latest.filter(F.col("id").isNotNull())
            .select(
                "id",
                json_extract_string("payload", "Name").alias("name"),
                json_extract_string("payload", "PublicCode").alias("public_code"),
                json_extract_string("payload", "RouteRef").alias("route_id"),
                json_extract_string("payload", "DirectionRef").alias("direction"),
                "Ingestion_Date"))


def stg_netex_quays(bronze_quays: DataFrame) -> DataFrame:
    """MDL-3: quay name, parent stop place and ``lat,lon`` location text."""
    latest = latest_per_key(bronze_quays, BRONZE_NETEX_KEY)
    return (latest.filter(F.col("id").isNotNull())
            .select(
                F.col("id").alias("QuayId"),
                json_extract_string("payload", "Name").alias("QuayName"),
                json_extract_string("payload", "stopPlaceId").alias("ParentStopPointId"),
                location_text(json_extract_string("payload", "Centroid_Lat"),
                              json_extract_string("payload", "Centroid_Long")).alias("Location"),
                "Ingestion_Date"))

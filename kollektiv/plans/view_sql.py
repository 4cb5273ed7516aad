"""Staging and silver models as SQL text, for views in a catalog (SNK-3).

The same models as ``plans.staging`` and ``plans.silver``, over tables and views
of one database; a test holds every view against its DataFrame form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from kollektiv.schemas import (
    BRONZE_LIVE, BRONZE_LIVE_KEY, BRONZE_NETEX, BRONZE_NETEX_KEY, NETEX_RECORDS, PARTITION_COLUMN, TIMETABLE_COLUMNS, VERSION_COLUMN,
)

SILVER_TABLE = "silver_timetable_days"


def latest_rows(table: str, schema: T.StructType, key: Sequence[str]) -> str:
    """Replace-on-key (AGG-6) of a bronze table: newest row by day and key, ties
    by the remaining columns, greatest first."""
    groups = [PARTITION_COLUMN, *key]
    order = [VERSION_COLUMN, *(f.name for f in schema.fields if f.name not in {*groups, VERSION_COLUMN})]
    return (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(groups)} ORDER BY "
            f"{', '.join(f'{c} DESC NULLS LAST' for c in order)}) AS newest FROM {table}) WHERE newest = 1)")


def _json(key: str) -> str:
    return f"coalesce(get_json_object(payload, '$.{key}'), '')"


def view_statements(database: str, zone: str | None = None, maintained_silver: bool = False) -> dict[str, str]:
    """{view: SELECT}, each after those it reads.  ``maintained_silver``: the
    silver timetable is the table kept day by day."""
    def name(table: str) -> str:
        return f"`{database}`.`{table}`"

    lines = latest_rows(name(NETEX_RECORDS["line"][1]), BRONZE_NETEX, BRONZE_NETEX_KEY)
    quays = latest_rows(name(NETEX_RECORDS["quay"][1]), BRONZE_NETEX, BRONZE_NETEX_KEY)
    live = latest_rows(name("bronze_live_timetable"), BRONZE_LIVE, BRONZE_LIVE_KEY)
    arrival = "AimedArrivalTime"
    if zone and zone.upper() not in ("UTC", "Z", "ETC/UTC"):
        arrival = f"convert_timezone('UTC', '{zone}', AimedArrivalTime)"
    timetable = ", ".join(f"to_date({arrival}) AS DateId" if c == "DateId" else c for c in TIMETABLE_COLUMNS)
    return {
        "stg_live_timetable": f"SELECT {', '.join(TIMETABLE_COLUMNS)} FROM {live} WHERE ServiceJourneyId IS NOT NULL",
        "stg_netex_lines": f"SELECT id, {_json('Name')} AS name, {_json('PublicCode')} AS public_code, {_json('RouteRef')} AS route_id, "
                           f"{_json('DirectionRef')} AS direction, Ingestion_Date FROM {lines} WHERE id IS NOT NULL",
        "stg_netex_quays": f"SELECT id AS QuayId, {_json('Name')} AS QuayName, {_json('stopPlaceId')} AS ParentStopPointId, "
                           f"concat({_json('Centroid_Lat')}, ',', {_json('Centroid_Long')}) AS Location, Ingestion_Date "
                           f"FROM {quays} WHERE id IS NOT NULL",
        "silver_timetable": f"SELECT {', '.join(TIMETABLE_COLUMNS)} FROM {name(SILVER_TABLE)}" if maintained_silver else
                            f"SELECT {timetable} FROM {name('stg_live_timetable')} WHERE ActualArrivalTime IS NOT NULL",
        "silver_lines": f"SELECT DISTINCT id, name, public_code, route_id, direction, Ingestion_Date FROM {name('stg_netex_lines')}",
    }

"""Explicit schemas for every record, bronze, silver and gold table.

Nothing is inferred: inference costs an extra pass and makes columns appear
and vanish between loads.  Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall
clock time, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, DBL, L = T.StringType(), T.DateType(), T.TimestampNTZType(), T.DoubleType(), T.LongType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# --- NeTEx records (SRC-3 .. SRC-9); every field is the raw XML text -------
# Fixed values that must equal the reference's: the record field names.
TOPOGRAPHIC_PLACE_FIELDS = (
    "id", "version", "IsoCode", "Descriptor", "TopographicPlaceType", "CountryRef",
    "PrivateCode", "ParentTopographicPlaceRef", "ParentTopographicPlaceVersion",
)
STOP_PLACE_FIELDS = (
    "id", "version", "Name", "ShortName", "PrivateCode", "Centroid_Long", "Centroid_Lat",
    "TopographicPlaceRef", "TopographicPlaceVersion", "OrganisationRef", "ParentSiteRef",
    "ParentSiteVersion", "TransportMode", "StopPlaceType",
)
QUAY_FIELDS = ("id", "version", "stopPlaceId")
# D8: optional quay attributes, off by default (parity with the reference).
QUAY_OPTIONAL_FIELDS = ("Name", "Centroid_Long", "Centroid_Lat")
SCHEDULED_STOP_POINT_FIELDS = (
    "id", "version", "Name", "PublicCode", "StopPlaceRef", "StopPlaceRefVersion",
    "Centroid_Long", "Centroid_Lat",
)
LINE_FIELDS = ("id", "version", "Name", "PublicCode")
JOURNEY_PATTERN_FIELDS = ("id", "version", "RouteRef")
# stopOrder stays text in the record stream; SCL-9 types it on the JVM side.
JOURNEY_PATTERN_STOP_FIELDS = (
    "journeyPatternId", "stopOrder", "scheduledStopPointRef", "stopPointInJourneyPatternId",
    "forBoarding", "forAlighting",
)

# Fixed values that must equal the reference's: dataset names and bronze table
# names.  record_type -> (dataset name, bronze table name, fields)
NETEX_RECORDS = {
    "scheduled_stop_point": ("netex_scheduled_stop_points", "bronze_netex_scheduled_stop_points",
                             SCHEDULED_STOP_POINT_FIELDS),
    "topographic_place": ("netex_topographic_places", "bronze_netex_topographic_places",
                          TOPOGRAPHIC_PLACE_FIELDS),
    "stop_place": ("netex_stop_places", "bronze_netex_stop_places", STOP_PLACE_FIELDS),
    "quay": ("netex_quays", "bronze_netex_quays", QUAY_FIELDS + QUAY_OPTIONAL_FIELDS),
    "line": ("netex_lines", "bronze_netex_lines", LINE_FIELDS),
    "journey_pattern": ("netex_journey_patterns", "bronze_netex_journey_patterns",
                        JOURNEY_PATTERN_FIELDS),
    "journey_pattern_stop": ("netex_journey_pattern_stops", "bronze_netex_journey_pattern_stops",
                             JOURNEY_PATTERN_STOP_FIELDS),
}


def netex_fields(record_type: str, quay_details: bool = False) -> tuple[str, ...]:
    fields = NETEX_RECORDS[record_type][2]
    if record_type == "quay" and not quay_details:
        fields = QUAY_FIELDS
    return fields


def netex_tagged_schema(record_types=tuple(NETEX_RECORDS), quay_details: bool = False) -> T.StructType:
    """One walk over a document emits tagged records: ``record_type`` plus the
    record's values in positional slots ``v0..v{k-1}`` (k = widest requested
    type), so the stream stays narrow whatever the mix of types."""
    k = max(len(netex_fields(t, quay_details)) for t in record_types)
    return T.StructType(
        [T.StructField("path", S, True), T.StructField("member", S, True), T.StructField("ordinal", L, True),
         T.StructField("record_type", S, False), T.StructField("seq", L, True),
         T.StructField("error", S, True)]
        + _strings(*[f"v{i}" for i in range(k)]))


def netex_record_schema(record_type: str) -> T.StructType:
    return T.StructType(_strings(*NETEX_RECORDS[record_type][2]))


# --- Bronze -----------------------------------------------------------------
BRONZE_NETEX = T.StructType([
    T.StructField("dataset", S, False),
    T.StructField("id", S, True),
    T.StructField("version", S, True),
    T.StructField("payload", S, True),
    T.StructField("Ingestion_Timestamp", TS, True),
    T.StructField("Ingestion_Date", D, True),
])
BRONZE_NETEX_KEY = ("dataset", "id")

LIVE_STRING_COLUMNS = (
    "ServiceJourneyId", "QuayId", "StopPointId", "LineId", "RouteId", "DirectionRef",
    "VehicleMode", "ArrivalStatus", "DepartureStatus", "Cancellation", "DepartureBoardingActivity",
)
LIVE_TIME_COLUMNS = ("AimedArrivalTime", "ActualArrivalTime", "AimedDepartureTime", "ActualDepartureTime")

BRONZE_LIVE = T.StructType([
    T.StructField("ServiceJourneyId", S, True),
    T.StructField("QuayId", S, True),
    T.StructField("StopPointId", S, True),
    T.StructField("DateId", D, True),
    T.StructField("LineId", S, True),
    T.StructField("RouteId", S, True),
    T.StructField("DirectionRef", S, True),
    T.StructField("VehicleMode", S, True),
    T.StructField("AimedArrivalTime", TS, True),
    T.StructField("ActualArrivalTime", TS, True),
    T.StructField("AimedDepartureTime", TS, True),
    T.StructField("ActualDepartureTime", TS, True),
    T.StructField("ArrivalStatus", S, True),
    T.StructField("DepartureStatus", S, True),
    T.StructField("Cancellation", S, True),
    T.StructField("DepartureBoardingActivity", S, True),
    T.StructField("Ingestion_Timestamp", TS, True),
    T.StructField("Ingestion_Date", D, True),
])
BRONZE_LIVE_KEY = ("ServiceJourneyId", "QuayId", "DateId")
LIVE_COLUMNS = tuple(f.name for f in BRONZE_LIVE.fields)
# staging / silver timetable: bronze without Ingestion_Timestamp
TIMETABLE_COLUMNS = tuple(c for c in LIVE_COLUMNS if c != "Ingestion_Timestamp")

PARTITION_COLUMN = "Ingestion_Date"
VERSION_COLUMN = "Ingestion_Timestamp"

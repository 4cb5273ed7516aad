"""DuckDB oracle SQL for every registered query (same column names and types).

The CTEs mirror ``kollektiv.roles``: the same projections of the driver's
tables, written in SQL.  Orderings state NULLS FIRST/LAST explicitly.
"""

from __future__ import annotations

from kollektiv.schemas import BRONZE_LIVE_KEY, LIVE_COLUMNS, TIMETABLE_COLUMNS

LIVE_CTE = """L AS (
  SELECT
    CAST(user_id AS VARCHAR) AS ServiceJourneyId,
    event_type AS QuayId,
    event_type AS StopPointId,
    CAST(ts AS DATE) AS DateId,
    'line-' || CAST(user_id % 12 AS VARCHAR) AS LineId,
    'route-' || CAST(user_id % 12 AS VARCHAR) || '-' || CAST(user_id % 2 AS VARCHAR) AS RouteId,
    CAST(user_id % 2 + 1 AS VARCHAR) AS DirectionRef,
    CASE WHEN user_id % 5 = 0 THEN 'tram' ELSE 'bus' END AS VehicleMode,
    date_trunc('millisecond', ts) AS AimedArrivalTime,
    CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) + to_seconds(event_id % 600) END AS ActualArrivalTime,
    date_trunc('millisecond', ts) + to_seconds(30) AS AimedDepartureTime,
    CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) + to_seconds(event_id % 600 + 30) END AS ActualDepartureTime,
    CASE WHEN event_type = 'error' THEN 'missed' WHEN event_id % 600 > 180 THEN 'delayed' ELSE 'onTime' END AS ArrivalStatus,
    CASE WHEN event_type = 'error' THEN 'missed' WHEN event_id % 600 > 150 THEN 'delayed' ELSE 'onTime' END AS DepartureStatus,
    CASE WHEN event_type <> 'error' THEN 'false' ELSE 'true' END AS Cancellation,
    CASE WHEN event_type = 'signup' THEN 'noBoarding' ELSE 'boarding' END AS DepartureBoardingActivity,
    date_trunc('millisecond', ts) AS Ingestion_Timestamp,
    CAST(ts AS DATE) AS Ingestion_Date
  FROM events)"""


def _desc_rest(columns, exclude):
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns if c not in exclude)


_LIVE_GROUPS = ("Ingestion_Date",) + BRONZE_LIVE_KEY
LATEST_CTE = f"""LATEST AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {", ".join(_LIVE_GROUPS)}
      ORDER BY Ingestion_Timestamp DESC NULLS LAST, {_desc_rest(LIVE_COLUMNS, _LIVE_GROUPS + ("Ingestion_Timestamp",))}
    ) AS rn FROM L) WHERE rn = 1)"""

STG_CTE = f"""STG AS (SELECT {", ".join(TIMETABLE_COLUMNS)} FROM LATEST WHERE ServiceJourneyId IS NOT NULL)"""

_SILVER_COLS = ", ".join("CAST(AimedArrivalTime AS DATE) AS DateId" if c == "DateId" else c
                         for c in TIMETABLE_COLUMNS)
SILVER_CTE = f"""SILVER AS (SELECT {_SILVER_COLS} FROM STG WHERE ActualArrivalTime IS NOT NULL)"""

LIVE_CHAIN = ",\n".join([LIVE_CTE, LATEST_CTE, STG_CTE, SILVER_CTE])

_FACT_HEAD = ("ServiceJourneyId", "QuayId", "AimedArrivalTime")
_FACT_ORDER = ", ".join([f"{c} ASC NULLS LAST" for c in _FACT_HEAD]
                        + [f"{c} ASC NULLS LAST" for c in TIMETABLE_COLUMNS if c not in _FACT_HEAD])

ORACLES: dict[str, str] = {}

ORACLES["replacing_latest_per_key"] = f"WITH {LIVE_CTE},\n{LATEST_CTE}\nSELECT * FROM LATEST"
ORACLES["stg_live_timetable"] = f"WITH {LIVE_CTE},\n{LATEST_CTE},\n{STG_CTE}\nSELECT * FROM STG"
ORACLES["silver_timetable"] = f"WITH {LIVE_CHAIN}\nSELECT * FROM SILVER"
ORACLES["fact_movements"] = f"""WITH {LIVE_CHAIN}
SELECT
  CAST(row_number() OVER (ORDER BY {_FACT_ORDER}) AS BIGINT) AS event_id,
  ServiceJourneyId AS service_journey_id, QuayId AS quay_id, StopPointId AS stop_point_id,
  CAST(AimedArrivalTime AS DATE) AS date_id, LineId AS line_id, RouteId AS route_id,
  DirectionRef AS direction, VehicleMode, AimedArrivalTime, ActualArrivalTime, AimedDepartureTime,
  ActualDepartureTime, ArrivalStatus, DepartureStatus, Cancellation, DepartureBoardingActivity,
  Ingestion_Date
FROM SILVER"""
ORACLES["dim_service_journey"] = f"""WITH {LIVE_CHAIN}
SELECT DISTINCT ServiceJourneyId AS service_journey_id, CAST(AimedArrivalTime AS DATE) AS date_id,
  DirectionRef AS direction, VehicleMode, LineId AS line_id, RouteId AS route_id
FROM SILVER WHERE ServiceJourneyId IS NOT NULL"""

# --- NeTEx-derived roles -----------------------------------------------------
LINES_STG_CTE = """LINES_STG AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS public_code,
         '' AS route_id, '' AS direction, DATE '2025-10-27' AS Ingestion_Date FROM part WHERE p_size % 2 = 1
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), upper(p_name), p_brand, '', '', DATE '2025-10-27' FROM part WHERE p_size % 2 = 0
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_name, p_brand, '', '', DATE '2025-10-28' FROM part)"""
ORACLES["stg_netex_lines"] = f"WITH {LINES_STG_CTE}\nSELECT * FROM LINES_STG"
ORACLES["silver_lines"] = f"WITH {LINES_STG_CTE}\nSELECT DISTINCT * FROM LINES_STG"
ORACLES["dim_line"] = f"""WITH {LINES_STG_CTE}, SL AS (SELECT DISTINCT * FROM LINES_STG)
SELECT id AS line_id, name, public_code, route_id, direction FROM SL"""

ORACLES["stg_netex_quays"] = """SELECT CAST(s_suppkey AS VARCHAR) AS QuayId, s_name AS QuayName,
  'SP-' || CAST(s_nationkey AS VARCHAR) AS ParentStopPointId,
  CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 THEN '59.' || lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') ELSE '' END
  || ',' ||
  CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_nationkey + 10 AS VARCHAR) || '.' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') ELSE '' END
  AS Location,
  DATE '2025-10-27' AS Ingestion_Date
FROM supplier"""

ORACLES["dim_quay"] = """WITH Q AS (
  SELECT CAST(doc_id AS VARCHAR) AS QuayId, 'Quay ' || lang || ' ' || CAST(doc_id AS VARCHAR) AS QuayName,
    source AS ParentStopPointId,
    '59.' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || ',' || '15.' || lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0') AS Location
  FROM documents),
S AS (
  SELECT CAST(doc_id AS VARCHAR) AS QuayId, 'SPT-' || CAST(quality AS VARCHAR) AS StopPointId FROM labels
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), 'SPT-' || CAST(quality AS VARCHAR) || '-t' FROM labels WHERE toxic = 1)
SELECT DISTINCT q.QuayId AS quay_id, coalesce(s.StopPointId, '') AS stop_point_id, q.QuayName AS quay_name,
  q.Location AS location, q.ParentStopPointId AS parent_stop_point_id
FROM Q q LEFT JOIN S s ON q.QuayId = s.QuayId
WHERE q.QuayId IS NOT NULL"""

# --- scalar functions ----------------------------------------------------------
ORACLES["json_payload_pack"] = """SELECT c_custkey, c_name AS name, c_mktsegment AS segment,
  CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE '' END AS private_code,
  CAST(5 AS BIGINT) AS n_keys, (c_custkey % 3 = 0) AS private_code_is_null
FROM customer"""

ORACLES["json_payload_truncate"] = """SELECT doc_id,
  c AS truncated, CASE WHEN c THEN CAST(900014 AS BIGINT) END AS kept_chars,
  CASE WHEN c THEN '' ELSE lang END AS lang, md5(CASE WHEN c THEN '' ELSE text END) AS text_md5,
  CAST(length(CASE WHEN c THEN '' ELSE text END) AS BIGINT) AS text_chars
FROM (SELECT *, doc_id % 50 = 0 AND length(text) > 0 AS c FROM documents)"""

ORACLES["json_extract_string"] = """SELECT c_custkey,
  CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN c_name ELSE '' END AS name,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS segment
FROM customer"""

ORACLES["parse_timestamp_coerce"] = """SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN date_trunc('second', ts)
       WHEN event_id % 4 = 3 THEN date_trunc('millisecond', ts) ELSE ts END AS parsed
FROM events
UNION ALL
SELECT event_id + 1000000000000, TIMESTAMP '2025-11-02 00:00:00' + to_hours(CAST(event_id % 8 AS INTEGER))
  + to_minutes(CAST(date_part('minute', ts) AS INTEGER)) + to_seconds(CAST(floor(date_part('second', ts)) AS INTEGER))
FROM events"""

ORACLES["parse_date_fallback"] = """SELECT event_id,
  CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(ts AS DATE) END AS DateId
FROM events"""

ORACLES["parse_double_coerce"] = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE (l_orderkey + l_linenumber) % 5
    WHEN 0 THEN NULL WHEN 1 THEN CAST(l_linenumber AS DOUBLE) + 0.5 WHEN 2 THEN NULL
    ELSE CAST(l_linenumber AS DOUBLE) END AS stopOrder
FROM lineitem"""

ORACLES["first_non_empty"] = """SELECT c_custkey,
  COALESCE(NULLIF(CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN '' END, ''),
           CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment WHEN c_custkey % 2 = 0 THEN 'unused' END) AS LineId
FROM customer"""

ORACLES["fill_empty_string"] = """SELECT d.doc_id, COALESCE(d.lang, '') AS lang,
  COALESCE(CAST(l.quality AS VARCHAR), '') AS quality, COALESCE(CAST(l.toxic AS VARCHAR), '') AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

# --- dedupe, ids ---------------------------------------------------------------
ORACLES["dedupe_latest_version"] = """SELECT id, version, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM (SELECT CAST(o_custkey AS VARCHAR) AS id, CAST(o_orderkey % 13 AS VARCHAR) AS version, o_orderkey
        FROM orders)) WHERE rn = 1"""

ORACLES["dedupe_full_row"] = "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"

ORACLES["positional_id"] = """SELECT o_orderkey, o_custkey,
  CAST(row_number() OVER (ORDER BY o_orderkey ASC NULLS LAST) - 1 AS VARCHAR) AS id FROM orders"""

# --- quality -------------------------------------------------------------------
ORACLES["dq_null_rate"] = f"""WITH {LIVE_CTE.replace("L AS (", "L0 AS (")},
L AS (SELECT * REPLACE (CASE WHEN dayofweek(Ingestion_Date) = 0 AND DirectionRef = '1' THEN NULL ELSE ActualArrivalTime END
                        AS ActualArrivalTime) FROM L0)
SELECT Ingestion_Date,
  CAST(count(*) FILTER (WHERE ActualArrivalTime IS NULL) AS BIGINT) AS null_count,
  CAST(count(*) AS BIGINT) AS total_count,
  CAST(count(*) FILTER (WHERE ActualArrivalTime IS NULL) AS DOUBLE) * CAST(100.0 AS DOUBLE) / count(*) AS null_pct,
  CAST(count(*) FILTER (WHERE ActualArrivalTime IS NULL) AS DOUBLE) * CAST(100.0 AS DOUBLE) / count(*) <= 50.0 AS gate_passed
FROM L GROUP BY Ingestion_Date"""

ORACLES["dq_line_ids"] = """WITH K AS (SELECT CAST(o_custkey AS VARCHAR) AS id, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS total_count,
  CAST(COALESCE(sum(CASE WHEN id IS NULL THEN n END), 0) AS BIGINT) AS null_ids,
  CAST(sum(n - 1) AS BIGINT) AS duplicate_ids,
  (COALESCE(sum(CASE WHEN id IS NULL THEN n END), 0) = 0 AND sum(n - 1) = 0) AS gate_passed
FROM K"""

_DOCS_LABELS = "(SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
ORACLES["test_not_null"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {_DOCS_LABELS}"
    for c in ("doc_id", "lang", "quality", "toxic"))

ORACLES["test_unique"] = """SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1"""

# --- frame shaping -------------------------------------------------------------
ORACLES["union_by_name"] = """SELECT s_suppkey AS id, s_name AS Name, s_nationkey AS nation, s_acctbal FROM supplier
UNION ALL BY NAME
SELECT c_mktsegment AS segment, c_custkey AS id, c_name AS Name, c_nationkey AS nation FROM customer"""

ORACLES["missing_column_backfill"] = """SELECT CAST(n_nationkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS version,
  CAST(NULL AS VARCHAR) AS IsoCode, n_name AS Descriptor, CAST(NULL AS VARCHAR) AS TopographicPlaceType,
  CAST(NULL AS VARCHAR) AS CountryRef, CAST(NULL AS VARCHAR) AS PrivateCode,
  CAST(n_regionkey AS VARCHAR) AS ParentTopographicPlaceRef, CAST(NULL AS VARCHAR) AS ParentTopographicPlaceVersion
FROM nation"""

ORACLES["ingest_envelope"] = """SELECT CAST(p_partkey AS VARCHAR) AS id, 'netex_lines' AS dataset,
  TIMESTAMP '2025-10-27 06:00:00' AS Ingestion_Timestamp, DATE '2025-10-27' AS Ingestion_Date FROM part"""

# --- XML sources -----------------------------------------------------------------
ORACLES["src_siri_calls"] = """SELECT
  CAST(user_id AS VARCHAR) AS ServiceJourneyId, event_type AS QuayId, event_type AS StopPointId,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS DateId,
  'line-' || CAST(user_id % 12 AS VARCHAR) AS LineId,
  CASE WHEN user_id % 3 = 2 THEN '' ELSE 'route-' || CAST(user_id % 12 AS VARCHAR) || '-' || CAST(user_id % 2 AS VARCHAR) END AS RouteId,
  CAST(user_id % 2 + 1 AS VARCHAR) AS DirectionRef,
  CASE WHEN user_id % 5 = 0 THEN 'tram' ELSE 'bus' END AS VehicleMode,
  date_trunc('millisecond', ts) AS AimedArrivalTime,
  CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) + to_seconds(event_id % 600) END AS ActualArrivalTime,
  date_trunc('millisecond', ts) + to_seconds(30) AS AimedDepartureTime,
  CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) + to_seconds(event_id % 600 + 30) END AS ActualDepartureTime,
  CASE WHEN user_id % 3 = 0 THEN 'onTime' ELSE 'delayed' END AS ArrivalStatus,
  CASE WHEN user_id % 4 <> 0 THEN 'onTime' ELSE '' END AS DepartureStatus,
  'false' AS Cancellation, 'boarding' AS DepartureBoardingActivity,
  TIMESTAMP '2025-10-27 06:00:00' AS Ingestion_Timestamp, DATE '2025-10-27' AS Ingestion_Date
FROM events"""

ORACLES["src_xml_topographic_places"] = """SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS id, '1' AS version,
  upper(substr(n_name, 1, 2)) AS IsoCode,
  CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE n_name END AS Descriptor,
  'country' AS TopographicPlaceType, lower(substr(n_name, 1, 2)) AS CountryRef,
  CAST(n_nationkey AS VARCHAR) AS PrivateCode, 'R' || CAST(n_regionkey AS VARCHAR) AS ParentTopographicPlaceRef,
  '1' AS ParentTopographicPlaceVersion
FROM nation
UNION ALL
SELECT 'R' || CAST(r_regionkey AS VARCHAR), '2', NULL, r_name, 'region', NULL, NULL, NULL, NULL FROM region"""

_SP_LON = "CAST(s_nationkey + 10 AS VARCHAR) || '.' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0')"
_SP_LAT = "'59.' || lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0')"
STOP_PLACES_SQL = f"""SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS id, CAST(s_suppkey % 4 + 1 AS VARCHAR) AS version,
  s_name AS Name, CASE WHEN s_suppkey % 2 = 0 THEN 'S' || CAST(s_suppkey AS VARCHAR) END AS ShortName,
  CAST(s_suppkey AS VARCHAR) AS PrivateCode,
  CASE WHEN s_suppkey % 3 <> 2 THEN {_SP_LON} END AS Centroid_Long,
  CASE WHEN s_suppkey % 3 <> 2 THEN {_SP_LAT} END AS Centroid_Lat,
  'N' || CAST(s_nationkey AS VARCHAR) AS TopographicPlaceRef, '1' AS TopographicPlaceVersion,
  CASE WHEN s_suppkey % 7 <> 0 THEN 'ORG' || CAST(s_suppkey % 7 AS VARCHAR) END AS OrganisationRef,
  CASE WHEN s_suppkey % 5 = 0 THEN 'P' || CAST(s_nationkey AS VARCHAR) END AS ParentSiteRef,
  CASE WHEN s_suppkey % 5 = 0 THEN '3' END AS ParentSiteVersion,
  'bus' AS TransportMode, 'onstreetBus' AS StopPlaceType
FROM supplier {{where}}
UNION ALL
SELECT 'S' || CAST(s_suppkey AS VARCHAR) || '-child', '1', s_name || ' child', NULL, NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, NULL, NULL, NULL
FROM supplier WHERE s_suppkey % 10 = 0 {{and_where}}"""
ORACLES["src_xml_stop_places"] = STOP_PLACES_SQL.format(where="", and_where="")
ORACLES["src_xml_namespaces"] = STOP_PLACES_SQL.format(where="", and_where="")
ORACLES["src_xml_malformed"] = STOP_PLACES_SQL.format(where="WHERE s_suppkey % 7 <> 0",
                                                      and_where="AND s_suppkey % 7 <> 0")

ORACLES["src_xml_quays"] = """SELECT DISTINCT 'Q' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS id,
  CAST(l_partkey % 3 + 1 AS VARCHAR) AS version, 'S' || CAST(l_suppkey AS VARCHAR) AS stopPlaceId
FROM lineitem"""

_SSP_LON = "'15.' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')"
_SSP_LAT = "'59.' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0')"
ORACLES["src_xml_scheduled_stop_points"] = f"""SELECT 'SSP' || CAST(p_partkey AS VARCHAR) AS id,
  CAST(p_size AS VARCHAR) AS version, p_name AS Name, p_brand AS PublicCode,
  'S' || CAST(p_partkey % 100 AS VARCHAR) AS StopPlaceRef, '1' AS StopPlaceRefVersion,
  CASE WHEN p_partkey % 5 IN (0, 3) THEN {_SSP_LON} END AS Centroid_Long,
  CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN {_SSP_LAT} END AS Centroid_Lat
FROM part"""

LINES_XML_SQL = """SELECT 'L' || CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_partkey % 3 <> 2 THEN CAST(p_size AS VARCHAR) END AS version,
  CASE WHEN p_partkey % 3 <> 2 THEN p_name END AS Name, CAST(p_size AS VARCHAR) AS PublicCode
FROM part"""
ORACLES["src_xml_lines"] = LINES_XML_SQL
ORACLES["src_zip_members"] = LINES_XML_SQL
ORACLES["src_zip_rejects"] = """WITH S AS (SELECT s_suppkey AS k, 'dmg-' || CAST(s_suppkey AS VARCHAR) AS stem FROM supplier)
SELECT stem || '.zip' AS archive, 'netex/' || stem || CASE WHEN length(stem) % 2 = 1 THEN '.XML' ELSE '.xml' END AS member,
  CAST(CASE WHEN k % 7 = 0 THEN 0 WHEN k % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_records, CAST(CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_rejects
FROM S
UNION ALL SELECT stem || '.zip', 'netex/' || stem || '-broken.xml', CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM S"""

ORACLES["src_xml_journey_patterns"] = """SELECT 'JP' || CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS version,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'R' || CAST(o_custkey AS VARCHAR) END AS RouteRef
FROM orders"""

ORACLES["src_xml_journey_pattern_stops"] = """SELECT 'JP' || CAST(l_orderkey AS VARCHAR) AS journeyPatternId,
  CASE l_suppkey % 4 WHEN 0 THEN CAST(l_linenumber AS DOUBLE) WHEN 1 THEN CAST(l_linenumber AS DOUBLE) + 0.5 END AS stopOrder,
  CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE 'SSP' || CAST(l_partkey AS VARCHAR) END AS scheduledStopPointRef,
  'SPJP-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS stopPointInJourneyPatternId,
  CASE WHEN l_returnflag = 'R' THEN 'false' ELSE 'true' END AS forBoarding,
  CASE WHEN l_linestatus = 'O' THEN 'true' END AS forAlighting
FROM lineitem"""

# --- sinks, ingest jobs, streaming --------------------------------------------------
ORACLES["bronze_append_latest"] = """SELECT 'netex_lines' AS dataset, CAST(p_partkey AS VARCHAR) AS id,
  CAST(p_size AS VARCHAR) AS version, CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END AS name,
  TIMESTAMP '2025-10-27 18:00:00' AS Ingestion_Timestamp, DATE '2025-10-27' AS Ingestion_Date
FROM part"""

_LIVE_SELECT = ", ".join(LIVE_COLUMNS)
_LIVE_SELECT_PLUS1H = ", ".join("Ingestion_Timestamp + INTERVAL 1 HOUR AS Ingestion_Timestamp"
                                if c == "Ingestion_Timestamp" else c for c in LIVE_COLUMNS)
ORACLES["partition_overwrite"] = f"""WITH {LIVE_CTE}
SELECT {_LIVE_SELECT}, strftime(Ingestion_Date, '%Y-%m-%d') AS partition_id
FROM L WHERE dayofweek(Ingestion_Date) NOT IN (0, 6)
UNION ALL
SELECT {_LIVE_SELECT_PLUS1H}, strftime(Ingestion_Date, '%Y-%m-%d') AS partition_id
FROM L WHERE dayofweek(Ingestion_Date) IN (0, 6) AND QuayId <> 'error'"""

ORACLES["empty_snapshot_skip"] = f"""WITH {LIVE_CTE}
SELECT *, 'skipped_empty' AS load_status FROM L"""

ORACLES["gold_publish"] = ORACLES["dim_line"]

_SIRI_CALLS_BODY = ORACLES["src_siri_calls"].split("TIMESTAMP '2025-10-27 06:00:00' AS Ingestion_Timestamp")[0]
ORACLES["stream_snapshot_overwrite"] = f"""WITH SNAP AS (
  SELECT *, CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(43200) AS snap_ts FROM events WHERE hour(ts) < 12
  UNION ALL
  SELECT *, CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(86340) FROM events WHERE dayofweek(ts) <> 0
  UNION ALL
  SELECT *, CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(86370) FROM events
  WHERE dayofweek(ts) = 1 AND event_type = 'error'),
VERDICT AS (
  SELECT snap_ts, CAST(snap_ts AS DATE) AS day,
    CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) * 100.0 / count(*) <= 50.0 AS passed
  FROM SNAP GROUP BY snap_ts),
CHOSEN AS (SELECT day, max(snap_ts) AS snap_ts FROM VERDICT WHERE passed GROUP BY day),
events AS (SELECT SNAP.* FROM SNAP JOIN CHOSEN USING (snap_ts))
{_SIRI_CALLS_BODY}
  snap_ts AS Ingestion_Timestamp,
  CAST(snap_ts AS DATE) AS Ingestion_Date
FROM events"""

# --- end-to-end jobs ---------------------------------------------------------------
_SIRI_DAY1 = ORACLES["src_siri_calls"]
ORACLES["live_ingest_fact_movements"] = f"""WITH B AS ({_SIRI_DAY1}),
LATEST AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY {", ".join(_LIVE_GROUPS)}
    ORDER BY Ingestion_Timestamp DESC NULLS LAST, {_desc_rest(LIVE_COLUMNS, _LIVE_GROUPS + ("Ingestion_Timestamp",))}
  ) AS rn FROM B) WHERE rn = 1),
{STG_CTE},
{SILVER_CTE}
SELECT
  CAST(row_number() OVER (ORDER BY {_FACT_ORDER}) AS BIGINT) AS event_id,
  ServiceJourneyId AS service_journey_id, QuayId AS quay_id, StopPointId AS stop_point_id,
  CAST(AimedArrivalTime AS DATE) AS date_id, LineId AS line_id, RouteId AS route_id,
  DirectionRef AS direction, VehicleMode, AimedArrivalTime, ActualArrivalTime, AimedDepartureTime,
  ActualDepartureTime, ArrivalStatus, DepartureStatus, Cancellation, DepartureBoardingActivity,
  Ingestion_Date
FROM SILVER"""

ORACLES["static_ingest_dim_line"] = """SELECT 'L' || CAST(p_partkey AS VARCHAR) AS line_id,
  CASE WHEN p_partkey % 3 <> 2 THEN p_name ELSE '' END AS name, CAST(p_size AS VARCHAR) AS public_code,
  '' AS route_id, '' AS direction
FROM part"""


# --- declared column tests ---------------------------------------------------------
_TEST_CTES = f"""WITH {LIVE_CHAIN},
{LINES_STG_CTE},
SL AS (SELECT DISTINCT * FROM LINES_STG),
DL AS (SELECT id AS line_id FROM SL),
QS AS (SELECT CAST(doc_id AS VARCHAR) AS QuayId FROM documents),
DQ AS (SELECT DISTINCT q.QuayId AS quay_id, coalesce(s.StopPointId, '') AS stop_point_id
       FROM QS q LEFT JOIN (SELECT DISTINCT QuayId, StopPointId FROM SILVER) s ON q.QuayId = s.QuayId),
DSJ AS (SELECT DISTINCT ServiceJourneyId AS service_journey_id, CAST(AimedArrivalTime AS DATE) AS date_id,
          DirectionRef, VehicleMode, LineId, RouteId FROM SILVER WHERE ServiceJourneyId IS NOT NULL),
FACT AS (SELECT CAST(row_number() OVER (ORDER BY {_FACT_ORDER}) AS BIGINT) AS event_id,
          ServiceJourneyId AS service_journey_id, QuayId AS quay_id FROM SILVER)"""


def _nn(model, table, col):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {table}")


def _uq(model, table, col):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'unique' AS test, CAST(count(*) AS BIGINT) AS failures FROM "
            f"(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")


_TEST_PARTS = [
    _uq("fact_movements", "FACT", "event_id"), _nn("fact_movements", "FACT", "event_id"),
    _nn("fact_movements", "FACT", "service_journey_id"), _nn("fact_movements", "FACT", "quay_id"),
    _uq("dim_line", "DL", "line_id"), _nn("dim_line", "DL", "line_id"),
    _uq("dim_quay", "DQ", "quay_id"), _nn("dim_quay", "DQ", "quay_id"),
    _uq("dim_service_journey", "DSJ", "service_journey_id"), _nn("dim_service_journey", "DSJ", "service_journey_id"),
    _nn("silver_timetable", "SILVER", "ServiceJourneyId"), _nn("silver_timetable", "SILVER", "QuayId"),
    _nn("silver_timetable", "SILVER", "LineId"), _nn("silver_timetable", "SILVER", "Ingestion_Date"),
    _nn("silver_lines", "SL", "Ingestion_Date"),
    "SELECT 'silver_lines', 'LineId', 'unique', CAST(NULL AS BIGINT)",
    "SELECT 'silver_lines', 'LineId', 'not_null', CAST(NULL AS BIGINT)",
]
ORACLES["declared_column_tests"] = f"""{_TEST_CTES},
R AS ({" UNION ALL ".join(_TEST_PARTS)})
SELECT model, column_name, test,
  CASE WHEN failures IS NULL THEN 'error' WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status, failures
FROM R"""
ORACLES["src_siri_calls_native"] = ORACLES["src_siri_calls"]

_CORRECTED = ", ".join({"ActualArrivalTime": "ActualArrivalTime + INTERVAL 1 MINUTE AS ActualArrivalTime",
                            "ArrivalStatus": "'corrected' AS ArrivalStatus",
                            "Ingestion_Timestamp": "Ingestion_Timestamp + INTERVAL 1 HOUR AS Ingestion_Timestamp"}.get(c, c)
                           for c in LIVE_COLUMNS)
_WEEKEND_BRONZE = f"""B AS (
  SELECT {_LIVE_SELECT} FROM L WHERE dayofweek(Ingestion_Date) NOT IN (0, 6)
  UNION ALL
  SELECT {_CORRECTED} FROM L WHERE dayofweek(Ingestion_Date) IN (0, 6))"""
ORACLES["silver_timetable_incremental"] = f"""WITH {LIVE_CTE},
{_WEEKEND_BRONZE},
{LATEST_CTE.replace("FROM L) WHERE rn = 1", "FROM B) WHERE rn = 1")},
{STG_CTE},
{SILVER_CTE}
SELECT * FROM SILVER"""

ORACLES["fact_movements_incremental"] = ORACLES["silver_timetable_incremental"].replace(
    "SELECT * FROM SILVER", ORACLES["fact_movements"].partition(f"WITH {LIVE_CHAIN}\n")[2])

ORACLES["dim_service_journey_incremental"] = ORACLES["silver_timetable_incremental"].replace(
    "SELECT * FROM SILVER", ORACLES["dim_service_journey"].partition(f"WITH {LIVE_CHAIN}\n")[2])
ORACLES["quay_stops_incremental"] = ORACLES["silver_timetable_incremental"].replace(
    "SELECT * FROM SILVER", "SELECT DISTINCT QuayId, StopPointId FROM SILVER")


# --- published views, the seven bronze tables -----------------------------------------
ORACLES["published_views"] = f"""WITH {LIVE_CHAIN},
{LINES_STG_CTE}
SELECT 'stg_live_timetable' AS view, * FROM STG
UNION ALL BY NAME SELECT 'silver_timetable' AS view, * FROM SILVER
UNION ALL BY NAME SELECT 'stg_netex_lines' AS view, * FROM LINES_STG
UNION ALL BY NAME SELECT 'silver_lines' AS view, * FROM (SELECT DISTINCT * FROM LINES_STG)
UNION ALL BY NAME SELECT 'stg_netex_quays' AS view, CAST(doc_id AS VARCHAR) AS QuayId,
  coalesce('Quay ' || lang || ' ' || CAST(doc_id AS VARCHAR), '') AS QuayName, coalesce(source, '') AS ParentStopPointId,
  '59.' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || ',' || coalesce('15.' || lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0'), '') AS Location,
  DATE '2025-10-27' AS Ingestion_Date
FROM documents"""

_STOP_ID = "\n    || chr(1) || ".join(f"coalesce({c}, chr(0))" for c in (
    "journeyPatternId", "stopPointInJourneyPatternId",
    "CASE WHEN stopOrder = floor(stopOrder) THEN CAST(CAST(stopOrder AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(stopOrder AS VARCHAR) END",
    "scheduledStopPointRef", "forBoarding", "forAlighting"))


def _bronze_part(dataset: str, source: str, value: str, id_: str = "id", version: str = "version") -> str:
    return (f"SELECT '{dataset}' AS dataset, {id_} AS id, {version} AS version, coalesce(CAST({value} AS VARCHAR), '') AS value, "
            f"'1761523200000' AS day_ms FROM ({source})")


ORACLES["static_ingest_bronze"] = "\nUNION ALL ".join([
    _bronze_part("netex_topographic_places", ORACLES["src_xml_topographic_places"], "Descriptor"),
    _bronze_part("netex_stop_places", ORACLES["src_xml_stop_places"], "Name"),
    _bronze_part("netex_quays", ORACLES["src_xml_quays"], "stopPlaceId"),
    _bronze_part("netex_scheduled_stop_points", ORACLES["src_xml_scheduled_stop_points"], "PublicCode"),
    _bronze_part("netex_lines", LINES_XML_SQL, "PublicCode"),
    _bronze_part("netex_journey_patterns", ORACLES["src_xml_journey_patterns"], "RouteRef"),
    _bronze_part("netex_journey_pattern_stops", ORACLES["src_xml_journey_pattern_stops"], "scheduledStopPointRef",
                 f"sha256({_STOP_ID})", "CAST(NULL AS VARCHAR)")])

ORACLES["static_reject_replay"] = "\nUNION ALL ".join([
    _bronze_part("netex_stop_places", ORACLES["src_xml_stop_places"], "Name"),
    _bronze_part("netex_scheduled_stop_points", ORACLES["src_xml_scheduled_stop_points"], "PublicCode"),
    _bronze_part("netex_lines", LINES_XML_SQL, "PublicCode")])

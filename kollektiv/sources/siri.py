"""SIRI estimated-timetable extraction (SRC-2, SRC-10) and typing to the
bronze live schema (SCL-6..8, SCL-10).

Extraction reads each document as an event stream (``sources.events``) and
only copies texts; every conversion — first non-empty of text and ``@ref``,
dates, ISO timestamps, null-to-empty — runs afterwards as JVM expressions.
Element names must carry the exact SIRI namespace (SRC-11).
"""

from __future__ import annotations

import datetime as _dt
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kollektiv.functions.scalars import (
    fill_empty_strings, first_non_empty, parse_service_date, parse_timestamp, run_clock, truncate_millis,
)
from kollektiv.schemas import BRONZE_LIVE, LIVE_COLUMNS, LIVE_STRING_COLUMNS, LIVE_TIME_COLUMNS
from kollektiv.session import ship_package
from kollektiv.sources import events

# Fixed value that must equal the reference's: the SIRI namespace.
SIRI_NS = "http://www.siri.org.uk/siri"

JOURNEY_TEXT = ("DirectionRef", "VehicleMode", "ArrivalStatus", "DepartureStatus", "Cancellation",
                "DepartureBoardingActivity")
CALL_TIMES = ("AimedArrivalTime", "ActualArrivalTime", "AimedDepartureTime", "ActualDepartureTime")

RAW_FIELDS = ("DataFrameRef", "DatedVehicleJourneyRef", "LineRef_text", "LineRef_ref", "RouteRef_text",
              "RouteRef_ref") + JOURNEY_TEXT + ("StopPointRef",) + CALL_TIMES
RAW_SCHEMA = T.StructType(
    [T.StructField("path", T.StringType(), True), T.StructField("seq", T.LongType(), True),
     T.StructField("error", T.StringType(), True)]
    + [T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])
_RAW_COLUMNS = RAW_SCHEMA.fieldNames()


class _Journey:
    """An ``EstimatedVehicleJourney``: its fields come from direct children, and
    every child of each ``RecordedCalls``, whatever its name, is a call.  A call
    gets the journey's fields when the journey closes, wherever they stood."""

    def __init__(self):
        self.fields, self.calls, self.area = {}, [], None

    def start(self, level, name, attrs):
        if level == 1:
            self.area = name
            if name in JOURNEY_TEXT:
                return self.fields, name
            if name in ("LineRef", "RouteRef"):          # SCL-10 picks one later
                self.fields[f"{name}_ref"] = attrs.get("ref")
                return self.fields, f"{name}_text"
        elif self.area == "FramedVehicleJourneyRef" and level == 2 and name in ("DataFrameRef", "DatedVehicleJourneyRef"):
            return self.fields, name
        elif self.area == "RecordedCalls" and level == 2:
            self.calls.append({})
        elif self.area == "RecordedCalls" and level == 3 and (name == "StopPointRef" or name in CALL_TIMES):
            return self.calls[-1], name
        return None

    def end(self, level):
        pass

    def close(self):
        return [("call", self.fields | c) for c in self.calls]


def _siri_name(tag: str) -> str:
    """The local name of a SIRI element; other elements keep their namespace
    (and ``}`` without one), so they equal no SIRI name."""
    return tag[len(SIRI_NS) + 1:] if tag.startswith(SIRI_NS + "}") else tag if "}" in tag else "}" + tag


def _open(name: str, _attrs: dict) -> _Journey | None:
    return _Journey() if name == "EstimatedVehicleJourney" else None


def walk_document(content) -> list[dict]:
    """All recorded calls of a document in memory.  Raises on malformed input."""
    raw = content.encode("utf-8") if isinstance(content, str) else content
    events.check(io.BytesIO(raw))
    return [call for _, call in events.read(io.BytesIO(raw), _siri_name, _open)]


_FLUSH_ROWS = 20_000


def _siri_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in _RAW_COLUMNS]
    types = [pa.int64() if c == "seq" else pa.string() for c in _RAW_COLUMNS]

    def add(path, seq, error, call) -> None:
        for column, value in zip(columns, (path, seq, error, *map(call.get, RAW_FIELDS)), strict=True):
            column.append(value)

    def take() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _RAW_COLUMNS)
        for c in columns:
            c.clear()
        return out
    for b in batches:
        for path, content in zip(b["path"], b["content"], strict=True):
            path, raw = path.as_py(), content.as_py() or b""
            try:
                events.check(io.BytesIO(raw))
            except events.MALFORMED as e:
                add(path, None, f"{type(e).__name__}: {e}", {})
                continue
            for seq, (_, call) in enumerate(events.read(io.BytesIO(raw), _siri_name, _open)):
                add(path, seq, None, call)
                if len(columns[0]) >= _FLUSH_ROWS:
                    yield take()
    yield take()


def extract(docs: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """Documents -> raw recorded calls (``RAW_SCHEMA``); a malformed document
    gives one row with ``error`` set and no calls."""
    src = docs.select(F.col(path).cast("string").alias("path"), F.col(content).cast("binary").alias("content"))
    ship_package(docs.sparkSession)
    return src.mapInArrow(_siri_batches, RAW_SCHEMA)


_REF = "struct<_VALUE:string,_ref:string>"
_CALL = ("struct<StopPointRef:string,AimedArrivalTime:string,ActualArrivalTime:string,"
         "AimedDepartureTime:string,ActualDepartureTime:string>")
_JOURNEY = (f"struct<LineRef:{_REF},RouteRef:{_REF},DirectionRef:string,VehicleMode:string,"
            "ArrivalStatus:string,DepartureStatus:string,Cancellation:string,DepartureBoardingActivity:string,"
            "FramedVehicleJourneyRef:struct<DataFrameRef:string,DatedVehicleJourneyRef:string>,"
            f"RecordedCalls:array<struct<RecordedCall:array<{_CALL}>>>>")
# the corrupt-record column must come last: placed earlier, nested elements parse as null;
# every level may be repeated
NATIVE_SCHEMA = ("struct<_xmlns:string,ServiceDelivery:array<struct<EstimatedTimetableDelivery:array<struct<"
                 f"EstimatedJourneyVersionFrame:array<struct<EstimatedVehicleJourney:array<{_JOURNEY}>>>>>>>,"
                 "corruptRecord:string>")


def extract_native(docs: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """JVM-side alternative to ``extract``: Spark's XML parser (``from_xml``)
    on each document, then its arrays flattened and exploded — no Python.

    Same output schema as ``extract``.  Narrower, by design of a fixed schema:
    journeys are read at the standard SIRI path
    (``ServiceDelivery/EstimatedTimetableDelivery/EstimatedJourneyVersionFrame``,
    each of them any number of times) and calls must be ``RecordedCall``
    elements.  SIRI must be the default namespace of the root: a document of
    another namespace, or with a prefix, is a reject row, as is one that does
    not parse.
    """
    x = F.from_xml(F.col(content).cast("string"), NATIVE_SCHEMA,
                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corruptRecord"})
    # one parse: what is exploded is not put back into the expressions above it
    parsed = (docs.select(F.col(path).cast("string").alias("path"), F.explode(F.array(x)).alias("x"))
              .withColumn("error", F.when(F.col("x").isNull() | F.col("x.corruptRecord").isNotNull(), "malformed document")
                          .when(~F.coalesce(F.col("x._xmlns") == SIRI_NS, F.lit(False)),
                                "the root's default namespace is not " + SIRI_NS)))

    def below(items, field):
        return F.flatten(F.transform(F.filter(F.coalesce(items, F.array()), lambda i: i.isNotNull()),
                                     lambda i: F.coalesce(i[field], F.array())))
    frames = below(below(F.col("x.ServiceDelivery"), "EstimatedTimetableDelivery"), "EstimatedJourneyVersionFrame")
    journeys = below(frames, "EstimatedVehicleJourney")
    rows = (parsed.select("path", "error", F.explode_outer(F.when(F.col("error").isNull(), journeys)).alias("j"))
            .select("path", "error", "j", F.explode_outer(below(F.col("j.RecordedCalls"), "RecordedCall")).alias("c"))
            .filter(F.col("error").isNotNull() | F.col("c").isNotNull()))
    j, c = F.col("j"), F.col("c")
    fields = {
        "DataFrameRef": j["FramedVehicleJourneyRef"]["DataFrameRef"],
        "DatedVehicleJourneyRef": j["FramedVehicleJourneyRef"]["DatedVehicleJourneyRef"],
        "LineRef_text": j["LineRef"]["_VALUE"], "LineRef_ref": j["LineRef"]["_ref"],
        "RouteRef_text": j["RouteRef"]["_VALUE"], "RouteRef_ref": j["RouteRef"]["_ref"],
        **{f: j[f] for f in JOURNEY_TEXT},
        "StopPointRef": c["StopPointRef"],
        **{f: c[f] for f in CALL_TIMES},
    }
    return rows.select("path", F.lit(None).cast("bigint").alias("seq"), "error",
                       *[v.cast("string").alias(k) for k, v in fields.items()])


def calls(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("error").isNull())


def rejects(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("error").isNotNull()).select("path", "error")


def to_bronze(raw_calls: DataFrame, ingestion_ts: _dt.datetime | None = None,
              ingestion_date: _dt.date | str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw calls -> the 18 bronze live columns (D1: missing strings are ``''``;
    D12: a missing or unparseable time stays null).

    The run clock is given as arguments, or — when ``ingestion_ts`` is None —
    read from ``Ingestion_Timestamp`` / ``Ingestion_Date`` columns already on
    the frame (streaming: one clock per snapshot).  ``keep`` columns are
    carried after the bronze columns.
    """
    stop = F.col("StopPointRef")
    clock = (run_clock(ingestion_ts, ingestion_date) if ingestion_ts is not None
             else {"Ingestion_Timestamp": F.col("Ingestion_Timestamp"), "Ingestion_Date": F.col("Ingestion_Date")})
    typed = raw_calls.select(
        F.col("DatedVehicleJourneyRef").alias("ServiceJourneyId"),
        stop.alias("QuayId"),
        stop.alias("StopPointId"),
        parse_service_date("DataFrameRef").alias("DateId"),
        first_non_empty("LineRef_text", "LineRef_ref").alias("LineId"),
        first_non_empty("RouteRef_text", "RouteRef_ref").alias("RouteId"),
        *[F.col(c) for c in JOURNEY_TEXT],
        *[truncate_millis(parse_timestamp(c)).alias(c) for c in LIVE_TIME_COLUMNS],
        *[v.alias(k) for k, v in clock.items()],
        *[F.col(k) for k in keep],
    )
    typed = fill_empty_strings(typed, LIVE_STRING_COLUMNS)
    return typed.select(*[F.col(c).cast(BRONZE_LIVE[c].dataType) for c in LIVE_COLUMNS], *keep)

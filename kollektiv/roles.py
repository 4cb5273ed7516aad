"""Reference-shaped inputs derived, by Spark, from the driver's tables.

The driver tables hold no transit data.  Each function here maps one of them
onto a role the pipeline knows (live calls, line and quay payloads, ...), as a
plain projection, so the work of every query grows with the tables.  The same
mappings are spelled out in SQL in ``kollektiv.oracles`` for the DuckDB check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv.functions.scalars import pack_json_payload, run_clock, truncate_millis
from kollektiv.schemas import BRONZE_LIVE, LIVE_COLUMNS

# Fixed run clocks used by the derived bronze tables.
DAY1 = _dt.date(2025, 10, 27)
DAY2 = _dt.date(2025, 10, 28)
RUN1 = _dt.datetime(2025, 10, 27, 6, 0, 0)
RUN2 = _dt.datetime(2025, 10, 27, 18, 0, 0)
RUN3 = _dt.datetime(2025, 10, 28, 6, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def live_bronze(events: DataFrame) -> DataFrame:
    """Live frame ``L``: one recorded call per event (18 bronze columns).

    journey = user, quay = stop point = event type, day = event day; an
    ``error`` event never arrived (null actual times).
    """
    ts = truncate_millis(F.col("ts"))
    delay = (F.col("event_id") % 600)
    arrived = F.col("event_type") != F.lit("error")
    user = F.col("user_id")
    cols = {
        "ServiceJourneyId": user.cast("string"),
        "QuayId": F.col("event_type"),
        "StopPointId": F.col("event_type"),
        "DateId": F.to_date("ts"),
        "LineId": F.concat(F.lit("line-"), (user % 12).cast("string")),
        "RouteId": F.concat(F.lit("route-"), (user % 12).cast("string"), F.lit("-"), (user % 2).cast("string")),
        "DirectionRef": (user % 2 + 1).cast("string"),
        "VehicleMode": F.when(user % 5 == 0, F.lit("tram")).otherwise(F.lit("bus")),
        "AimedArrivalTime": ts,
        "ActualArrivalTime": F.when(arrived, F.timestamp_add("SECOND", delay, ts)),
        "AimedDepartureTime": F.timestamp_add("SECOND", F.lit(30), ts),
        "ActualDepartureTime": F.when(arrived, F.timestamp_add("SECOND", delay + 30, ts)),
        "ArrivalStatus": F.when(~arrived, F.lit("missed"))
                          .when(delay > 180, F.lit("delayed")).otherwise(F.lit("onTime")),
        "DepartureStatus": F.when(~arrived, F.lit("missed"))
                            .when(delay > 150, F.lit("delayed")).otherwise(F.lit("onTime")),
        "Cancellation": F.when(arrived, F.lit("false")).otherwise(F.lit("true")),
        "DepartureBoardingActivity": F.when(F.col("event_type") == "signup", F.lit("noBoarding"))
                                      .otherwise(F.lit("boarding")),
        "Ingestion_Timestamp": ts,
        "Ingestion_Date": F.to_date("ts"),
    }
    out = events.select(*[cols[c].cast(BRONZE_LIVE[c].dataType).alias(c) for c in LIVE_COLUMNS])
    return out


def lines_run(part: DataFrame, name_col, ts, day) -> DataFrame:
    """One static run's ``bronze_netex_lines`` rows from ``part``."""
    rec = part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_size").cast("string").alias("version"),
        name_col.alias("Name"),
        F.col("p_brand").alias("PublicCode"))
    payload = pack_json_payload(["id", "version", "Name", "PublicCode"])
    return rec.select(F.lit("netex_lines").alias("dataset"), "id", "version",
                      payload.alias("payload"),
                      *[c.alias(k) for k, c in run_clock(ts, day).items()])


def renamed_lines():
    """Run 2's names: lines with an even size are renamed (upper case)."""
    return F.when(F.col("p_size") % 2 == 0, F.upper(F.col("p_name"))).otherwise(F.col("p_name"))


def lines_bronze(part: DataFrame) -> DataFrame:
    """``bronze_netex_lines`` over two ingestion days, three runs.

    Run 1 and run 2 land on day 1 (run 2 renames some lines, so replace-on-key
    has work to do); run 3 lands on day 2.
    """
    return (lines_run(part, F.col("p_name"), RUN1, DAY1)
            .unionByName(lines_run(part, renamed_lines(), RUN2, DAY1))
            .unionByName(lines_run(part, F.col("p_name"), RUN3, DAY2)))


def quays_bronze_from_suppliers(supplier: DataFrame) -> DataFrame:
    """``bronze_netex_quays`` from suppliers: every fifth has no coordinates,
    every third no latitude; the stop place is the supplier's nation."""
    key = F.col("s_suppkey")
    lat = F.when((key % 5 != 0) & (key % 3 != 0),
                 F.concat(F.lit("59."), F.lpad((key % 100000).cast("string"), 5, "0")))
    lon = F.when(key % 5 != 0,
                 F.concat((F.col("s_nationkey") + 10).cast("string"), F.lit("."),
                          F.lpad((key % 1000).cast("string"), 3, "0")))
    rec = supplier.select(
        key.cast("string").alias("id"),
        F.lit("1").alias("version"),
        F.col("s_name").alias("Name"),
        F.concat(F.lit("SP-"), F.col("s_nationkey").cast("string")).alias("stopPlaceId"),
        lon.alias("Centroid_Long"),
        lat.alias("Centroid_Lat"))
    payload = pack_json_payload(rec.columns)
    return rec.select(F.lit("netex_quays").alias("dataset"), "id", "version", payload.alias("payload"),
                      *[c.alias(k) for k, c in run_clock(RUN1, DAY1).items()])


def quays_bronze_from_documents(documents: DataFrame) -> DataFrame:
    """``bronze_netex_quays`` from documents (quay = document, stop place = source)."""
    rec = documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("1").alias("version"),
        F.concat(F.lit("Quay "), F.col("lang"), F.lit(" "), F.col("doc_id").cast("string")).alias("Name"),
        F.col("source").alias("stopPlaceId"),
        F.concat(F.lit("15."), F.lpad((F.col("n_chars") % 1000).cast("string"), 3, "0"))
         .alias("Centroid_Long"),
        F.concat(F.lit("59."), F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0"))
         .alias("Centroid_Lat"))
    payload = pack_json_payload(rec.columns)
    return rec.select(F.lit("netex_quays").alias("dataset"), "id", "version", payload.alias("payload"),
                      *[c.alias(k) for k, c in run_clock(RUN1, DAY1).items()])


def silver_from_labels(labels: DataFrame) -> DataFrame:
    """A silver timetable whose quays are labelled documents (``dim_quay``'s right side):
    stop point = quality/toxic code, two calls per label when toxic."""
    base = labels.select(
        F.col("doc_id").cast("string").alias("QuayId"),
        F.concat(F.lit("SPT-"), F.col("quality").cast("string")).alias("StopPointId"),
        F.col("toxic"))
    extra = base.filter(F.col("toxic") == 1).withColumn(
        "StopPointId", F.concat(F.col("StopPointId"), F.lit("-t")))
    return base.unionByName(extra).drop("toxic")

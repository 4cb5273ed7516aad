"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each query derives reference-shaped inputs from the driver's tables
(``kollektiv.roles``) and runs the pipeline's own operators over all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv import feeds, roles
from kollektiv.functions import scalars as S
from kollektiv.operators import counted_distinct, dedupe, frames, ids, order_table, quality
from kollektiv.operators.dedupe import latest_per_key
from kollektiv.plans import gold, live_ingest, silver, staging, static_ingest
from kollektiv.plans import models as model_run
from kollektiv.plans import quarantine
from kollektiv.schemas import (
    BRONZE_LIVE, BRONZE_LIVE_KEY, BRONZE_NETEX, BRONZE_NETEX_KEY, NETEX_RECORDS, netex_record_schema,
)
from kollektiv.session import scratch_path
from kollektiv.sinks import tables
from kollektiv.sinks.catalog import Database
from kollektiv.sources import archive, netex, siri
from kollektiv.streaming import live as live_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _live(spark, sf_dir):
    return roles.live_bronze(roles.table(spark, sf_dir, "events"))


def _silver(spark, sf_dir):
    return silver.silver_timetable(staging.stg_live_timetable(_live(spark, sf_dir)))


@register("replacing_latest_per_key")
def q_replacing_latest_per_key(spark, sf_dir):
    return latest_per_key(_live(spark, sf_dir), BRONZE_LIVE_KEY)


@register("stg_live_timetable")
def q_stg_live_timetable(spark, sf_dir):
    return staging.stg_live_timetable(_live(spark, sf_dir))


@register("silver_timetable")
def q_silver_timetable(spark, sf_dir):
    return _silver(spark, sf_dir)


@register("fact_movements")
def q_fact_movements(spark, sf_dir):
    return gold.fact_movements(_silver(spark, sf_dir))


@register("dim_service_journey")
def q_dim_service_journey(spark, sf_dir):
    return gold.dim_service_journey(_silver(spark, sf_dir))


def _stg_lines(spark, sf_dir):
    return staging.stg_netex_lines(roles.lines_bronze(roles.table(spark, sf_dir, "part")))


@register("stg_netex_lines")
def q_stg_netex_lines(spark, sf_dir):
    return _stg_lines(spark, sf_dir)


@register("silver_lines")
def q_silver_lines(spark, sf_dir):
    return silver.silver_lines(_stg_lines(spark, sf_dir))


@register("dim_line")
def q_dim_line(spark, sf_dir):
    return gold.dim_line(silver.silver_lines(_stg_lines(spark, sf_dir)))


@register("stg_netex_quays")
def q_stg_netex_quays(spark, sf_dir):
    return staging.stg_netex_quays(roles.quays_bronze_from_suppliers(roles.table(spark, sf_dir, "supplier")))


@register("dim_quay")
def q_dim_quay(spark, sf_dir):
    quays = staging.stg_netex_quays(roles.quays_bronze_from_documents(roles.table(spark, sf_dir, "documents")))
    movements = roles.silver_from_labels(roles.table(spark, sf_dir, "labels"))
    return gold.dim_quay(quays, movements)


# --- scalar functions ----------------------------------------------------------


@register("json_payload_pack")
def q_json_payload_pack(spark, sf_dir):
    c = roles.table(spark, sf_dir, "customer")
    rec = c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("PrivateCode"),
        F.col("c_nationkey").cast("string").alias("CountryRef"))
    packed = rec.select("id", S.pack_json_payload(rec.columns).alias("payload"))
    return packed.select(
        F.col("id").cast("bigint").alias("c_custkey"),
        S.json_extract_string("payload", "Name").alias("name"),
        S.json_extract_string("payload", "Segment").alias("segment"),
        S.json_extract_string("payload", "PrivateCode").alias("private_code"),
        F.size(F.json_object_keys("payload")).cast("bigint").alias("n_keys"),
        F.get_json_object("payload", "$.PrivateCode").isNull().alias("private_code_is_null"))


@register("json_payload_truncate")
def q_json_payload_truncate(spark, sf_dir):
    """Whole documents, every 50th repeated beyond the cap."""
    d = roles.table(spark, sf_dir, "documents")
    times = F.when((F.col("doc_id") % 50 == 0) & (F.length("text") > 0), F.ceil(F.lit(1_000_000) / F.length("text"))).otherwise(1)
    d = d.withColumn("text", F.repeat("text", times.cast("int")))
    packed = d.select("doc_id", S.cap_payload(
        S.pack_json_payload(["doc_id", "text", "lang", "source", "n_chars"])).alias("payload"))
    text = S.json_extract_string("payload", "text")
    truncated = F.col("payload").endswith(S.TRUNCATION_MARKER)
    return packed.select(
        "doc_id",
        truncated.alias("truncated"),
        F.when(truncated, F.length("payload")).cast("bigint").alias("kept_chars"),
        S.json_extract_string("payload", "lang").alias("lang"),
        F.md5(text).alias("text_md5"),
        F.length(text).cast("bigint").alias("text_chars"))


@register("json_extract_string")
def q_json_extract_string(spark, sf_dir):
    c = roles.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    full = F.to_json(F.struct(F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment")))
    null_name = F.to_json(F.struct(F.lit(None).cast("string").alias("Name"),
                                   F.col("c_mktsegment").alias("Segment")), {"ignoreNullFields": "false"})
    no_name = F.to_json(F.struct(F.col("c_mktsegment").alias("Segment")))
    broken = F.concat(F.lit('{"Name": "'), F.col("c_name"))
    payload = (F.when(k % 7 == 0, broken).when(k % 3 == 0, full).when(k % 3 == 1, null_name)
               .otherwise(no_name))
    return c.select("c_custkey", payload.alias("payload")).select(
        "c_custkey",
        S.json_extract_string("payload", "Name").alias("name"),
        S.json_extract_string("payload", "Segment").alias("segment"))


@register("parse_timestamp_coerce")
def q_parse_timestamp_coerce(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("not-a-time-"), F.col("event_id").cast("string"))) \
        .when(F.col("event_id") % 11 == 0, F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(1), F.col("ts")), "yyyyMMdd'T'HHmmss"), F.lit("+0100"))) \
        .otherwise(feeds.ts_text(F.col("ts"), F.col("event_id")))
    # the hours in which clocks go back: an instant has one reading in UTC
    e2 = e.select((F.col("event_id") + 1_000_000_000_000).alias("event_id"), F.concat(
        F.lit("2025-11-02T0"), F.pmod("event_id", F.lit(8)).cast("string"), F.date_format("ts", ":mm:ss"), F.lit("Z")).alias("t"))
    return e.select("event_id", text.alias("t")).union(e2).select("event_id", S.parse_timestamp("t").alias("parsed"))


@register("parse_date_fallback")
def q_parse_date_fallback(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    eid = F.col("event_id")
    text = (F.when(eid % 21 == 3, F.date_format("ts", "yyyyMMdd"))
            .when(eid % 21 == 6, F.date_format("ts", "yyyy/MM/dd"))
            .when(eid % 21 == 9, F.date_format("ts", "d MMM yyyy"))
            .when(eid % 21 == 12, F.date_format("ts", "MMMM d, yyyy"))
            .when(eid % 3 == 0, F.date_format("ts", "yyyy-MM-dd"))
            .when(eid % 3 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
            .otherwise(F.concat(F.lit("day-"), eid.cast("string"))))
    return e.select("event_id", S.parse_service_date(text).alias("DateId"))


@register("parse_double_coerce")
def q_parse_double_coerce(spark, sf_dir):
    li = roles.table(spark, sf_dir, "lineitem")
    r = (F.col("l_orderkey") + F.col("l_linenumber")) % 5
    text = (F.when(r == 0, F.concat(F.lit("x"), F.col("l_linenumber").cast("string")))
            .when(r == 1, F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")))
            .when(r == 2, F.lit(""))
            .otherwise(F.col("l_linenumber").cast("string")))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     S.parse_double(text).alias("stopOrder"))


@register("first_non_empty")
def q_first_non_empty(spark, sf_dir):
    c = roles.table(spark, sf_dir, "customer")
    m = F.col("c_custkey") % 3
    text = F.when(m == 0, F.col("c_name")).when(m == 1, F.lit(""))
    attr = F.when(m != 0, F.col("c_mktsegment")).when(F.col("c_custkey") % 2 == 0, F.lit("unused"))
    return c.select("c_custkey", S.first_non_empty(text, attr).alias("LineId"))


@register("fill_empty_string")
def q_fill_empty_string(spark, sf_dir):
    d = roles.table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = roles.table(spark, sf_dir, "labels")
    return S.fill_empty_strings(d.join(lab, "doc_id", "left"), ["lang", "quality", "toxic"])


# --- dedupe, ids ---------------------------------------------------------------
def _versioned_orders(spark, sf_dir):
    o = roles.table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").cast("string").alias("id"),
                    (F.col("o_orderkey") % 13).cast("string").alias("version"), "o_orderkey")


@register("dedupe_latest_version")
def q_dedupe_latest_version(spark, sf_dir):
    return dedupe.latest_version(_versioned_orders(spark, sf_dir), "id", "version",
                                 tiebreak=[F.col("o_orderkey").desc_nulls_last()])


@register("dedupe_full_row")
def q_dedupe_full_row(spark, sf_dir):
    return dedupe.drop_full_duplicates(roles.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"))


@register("positional_id")
def q_positional_id(spark, sf_dir):
    o = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return ids.positional_id(o, [F.col("o_orderkey").asc_nulls_last()], name="id")


# --- quality -------------------------------------------------------------------
@register("dq_null_rate")
def q_dq_null_rate(spark, sf_dir):
    live = _live(spark, sf_dir)
    # Sundays lose the arrivals of one direction, so some days fail the gate
    outage = (F.dayofweek("Ingestion_Date") == 1) & (F.col("DirectionRef") == "1")
    live = live.withColumn("ActualArrivalTime", F.when(~outage, F.col("ActualArrivalTime")))
    rates = quality.null_rate(live, "ActualArrivalTime", by=["Ingestion_Date"])
    return rates.withColumn("gate_passed", quality.passes_null_rate("ActualArrivalTime"))


@register("dq_line_ids")
def q_dq_line_ids(spark, sf_dir):
    o = roles.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id"))
    prof = quality.key_profile(o, "id")
    return prof.withColumn("gate_passed", (F.col("null_ids") == 0) & (F.col("duplicate_ids") == 0))


def _docs_labels(spark, sf_dir):
    d = roles.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return d.join(roles.table(spark, sf_dir, "labels"), "doc_id", "left")


@register("test_not_null")
def q_test_not_null(spark, sf_dir):
    return quality.not_null_failures(_docs_labels(spark, sf_dir), ["doc_id", "lang", "quality", "toxic"])


@register("test_unique")
def q_test_unique(spark, sf_dir):
    return quality.unique_failures(roles.table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey")


# --- frame shaping -------------------------------------------------------------
@register("union_by_name")
def q_union_by_name(spark, sf_dir):
    s = roles.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("Name"),
        F.col("s_nationkey").alias("nation"), "s_acctbal")
    c = roles.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"),
        F.col("c_name").alias("Name"), F.col("c_nationkey").alias("nation"))
    return frames.union_by_name([s, c])


@register("missing_column_backfill")
def q_missing_column_backfill(spark, sf_dir):
    n = roles.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("ID"), F.col("n_name").alias("Descriptor"),
        F.col("n_regionkey").cast("string").alias("ParentTopographicPlaceRef"))
    schema = netex_record_schema("topographic_place")
    out = frames.backfill_columns(frames.ensure_version(frames.ensure_id(n)), schema)
    return out.select(*schema.fieldNames())


@register("ingest_envelope")
def q_ingest_envelope(spark, sf_dir):
    p = roles.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"))
    return frames.add_envelope(p, "netex_lines", roles.RUN1, roles.DAY1)


# --- XML sources -----------------------------------------------------------------


@register("src_siri_calls")
def q_src_siri_calls(spark, sf_dir):
    docs = feeds.siri_timetable(roles.table(spark, sf_dir, "events"))
    raw = siri.extract(docs)
    return siri.to_bronze(siri.calls(raw), roles.RUN1, roles.DAY1)


@register("src_xml_topographic_places")
def q_src_xml_topographic_places(spark, sf_dir):
    docs = feeds.topographic_places(roles.table(spark, sf_dir, "nation"), roles.table(spark, sf_dir, "region"))
    return netex.records(netex.extract(docs, record_types=("topographic_place",)), "topographic_place")


@register("src_xml_stop_places")
def q_src_xml_stop_places(spark, sf_dir):
    docs = feeds.stop_places(roles.table(spark, sf_dir, "supplier"))
    return netex.records(netex.extract(docs, record_types=("stop_place",)), "stop_place")


@register("src_xml_quays")
def q_src_xml_quays(spark, sf_dir):
    docs = feeds.quays(roles.table(spark, sf_dir, "lineitem"))
    return netex.records(netex.extract(docs, record_types=("quay",)), "quay").select("id", "version", "stopPlaceId")


@register("src_xml_scheduled_stop_points")
def q_src_xml_scheduled_stop_points(spark, sf_dir):
    docs = feeds.scheduled_stop_points(roles.table(spark, sf_dir, "part"))
    return netex.records(netex.extract(docs, record_types=("scheduled_stop_point",)), "scheduled_stop_point")


@register("src_xml_lines")
def q_src_xml_lines(spark, sf_dir):
    docs = feeds.lines(roles.table(spark, sf_dir, "part"))
    return netex.records(netex.extract(docs, record_types=("line",)), "line")


@register("src_xml_journey_patterns")
def q_src_xml_journey_patterns(spark, sf_dir):
    docs = feeds.journey_patterns(roles.table(spark, sf_dir, "orders"))
    return netex.records(netex.extract(docs, record_types=("journey_pattern",)), "journey_pattern")


@register("src_xml_journey_pattern_stops")
def q_src_xml_journey_pattern_stops(spark, sf_dir):
    docs = feeds.journey_pattern_stops(roles.table(spark, sf_dir, "lineitem"))
    return netex.records(netex.extract(docs, record_types=("journey_pattern_stop",)), "journey_pattern_stop")


@register("src_xml_namespaces")
def q_src_xml_namespaces(spark, sf_dir):
    docs = feeds.namespaced_stop_places(roles.table(spark, sf_dir, "supplier"))
    return netex.records(netex.extract(docs, record_types=("stop_place",)), "stop_place")


@register("src_xml_malformed")
def q_src_xml_malformed(spark, sf_dir):
    docs = feeds.damaged_stop_places(roles.table(spark, sf_dir, "supplier"))
    return netex.records(netex.extract(docs, record_types=("stop_place",)), "stop_place")


@register("src_zip_members")
def q_src_zip_members(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    zips = feeds.zip_archives(feeds.lines(roles.table(spark, sf_dir, "part")))
    archive.write_files(zips, landing).count()          # land the archives (executor-side writes)
    members = archive.zip_members(spark, landing)
    return netex.records(netex.extract(members.filter(F.col("error").isNull()), record_types=("line",)), "line")


@register("src_zip_rejects")
def q_src_zip_rejects(spark, sf_dir):
    """Records and rejects of every member: each archive has one XML member
    that is malformed, and the document of every seventh is cut short."""
    landing = scratch_path(spark, "landing")
    archive.write_files(feeds.zip_archives(feeds.damaged_stop_places(roles.table(spark, sf_dir, "supplier"))), landing).count()
    tagged = netex.extract_landing(spark, landing, record_types=("stop_place",))
    return tagged.groupBy(F.element_at(F.split("path", "/"), -1).alias("archive"), "member").agg(
        F.count_if(F.col("record_type") == "stop_place").alias("n_records"),
        F.count_if((F.col("record_type") == netex.REJECT) & F.col("error").contains("ExpatError")).alias("n_rejects"))


# --- sinks, ingest jobs, streaming --------------------------------------------------


@register("bronze_append_latest")
def q_bronze_append_latest(spark, sf_dir):
    path = scratch_path(spark, "bronze_netex_lines")
    part = roles.table(spark, sf_dir, "part")
    tables.append_bronze(roles.lines_run(part, F.col("p_name"), roles.RUN1, roles.DAY1), path,
                         sort_key=list(BRONZE_NETEX_KEY))
    tables.append_bronze(roles.lines_run(part, roles.renamed_lines(), roles.RUN2, roles.DAY1), path,
                         sort_key=list(BRONZE_NETEX_KEY))
    latest = latest_per_key(tables.read_table(spark, path, BRONZE_NETEX), BRONZE_NETEX_KEY)
    return latest.select("dataset", "id", "version", S.json_extract_string("payload", "Name").alias("name"),
                         "Ingestion_Timestamp", "Ingestion_Date")


def _weekend_rerun(live):
    """A corrected re-run for weekend days: calls that never arrived are gone,
    the run is an hour later."""
    weekend = F.dayofweek("Ingestion_Date").isin(1, 7)
    return (live.filter(weekend & (F.col("QuayId") != "error"))
            .withColumn("Ingestion_Timestamp", F.timestamp_add("HOUR", F.lit(1), F.col("Ingestion_Timestamp"))))


@register("partition_overwrite")
def q_partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "bronze_live")
    live = _live(spark, sf_dir)
    tables.overwrite_partitions(live, path, sort_key=list(BRONZE_LIVE_KEY))
    tables.overwrite_partitions(_weekend_rerun(live), path, sort_key=list(BRONZE_LIVE_KEY))
    out = tables.read_table(spark, path, BRONZE_LIVE)
    return out.withColumn("partition_id", S.partition_id("Ingestion_Date"))


@register("empty_snapshot_skip")
def q_empty_snapshot_skip(spark, sf_dir):
    path = scratch_path(spark, "bronze_live")
    events = roles.table(spark, sf_dir, "events")
    tables.overwrite_partitions(roles.live_bronze(events), path, sort_key=list(BRONZE_LIVE_KEY))
    load = live_ingest.ingest_snapshot(feeds.siri_heartbeats(events), path, roles.RUN3, roles.DAY2)
    return tables.read_table(spark, path, BRONZE_LIVE).withColumn("load_status", F.lit(load.status))


@register("gold_publish")
def q_gold_publish(spark, sf_dir):
    path = scratch_path(spark, "dim_line")
    tables.publish_table(gold.dim_line(silver.silver_lines(_stg_lines(spark, sf_dir))), path)
    tables.publish_table(tables.read_table(spark, path), path)    # rebuild from itself
    return tables.read_table(spark, path)


@register("stream_snapshot_overwrite")
def q_stream_snapshot_overwrite(spark, sf_dir):
    landing, bronze = scratch_path(spark, "siri_landing"), scratch_path(spark, "bronze_live")
    archive.write_files(feeds.siri_snapshots(roles.table(spark, sf_dir, "events")), landing).count()
    q = live_stream.run_live_stream(spark, landing, bronze, scratch_path(spark, "stream_ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return tables.read_table(spark, bronze, BRONZE_LIVE)


# --- end-to-end jobs (entry points A, B, C) ------------------------------------------


@register("live_ingest_fact_movements")
def q_live_ingest_fact_movements(spark, sf_dir):
    """A: one SIRI snapshot of every event -> gate -> day overwrite -> models -> fact."""
    root = scratch_path(spark, "bronze")
    docs = feeds.siri_timetable(roles.table(spark, sf_dir, "events"))
    live_ingest.ingest_snapshot(docs, f"{root}/bronze_live_timetable", roles.RUN1, roles.DAY1)
    bronze_live = tables.read_table(spark, f"{root}/bronze_live_timetable", BRONZE_LIVE)
    return gold.fact_movements(silver.silver_timetable(staging.stg_live_timetable(bronze_live)))


@register("static_ingest_dim_line")
def q_static_ingest_dim_line(spark, sf_dir):
    """B + C: NeTEx archives -> seven bronze tables -> models -> published dim_line."""
    landing, root = scratch_path(spark, "netex_landing"), scratch_path(spark, "bronze")
    part = roles.table(spark, sf_dir, "part")
    docs = feeds.lines(part).unionByName(feeds.scheduled_stop_points(part))
    archive.write_files(feeds.zip_archives(docs), landing).count()
    static_ingest.ingest_archives(spark, landing, root, roles.RUN1, roles.DAY1)
    # no live data in this run: an empty live table keeps the model graph whole
    tables.overwrite_partitions(spark.createDataFrame([], BRONZE_LIVE), f"{root}/bronze_live_timetable")
    spark.createDataFrame([], BRONZE_NETEX).write.mode("append").partitionBy("Ingestion_Date").parquet(
        f"{root}/bronze_netex_quays")
    gold_paths = model_run.run_models(spark, root, scratch_path(spark, "gold"))
    return tables.read_table(spark, gold_paths["dim_line"])


@register("published_views")
def q_published_views(spark, sf_dir):
    """SNK-3: all rows of the five views, read by name from another session
    after the run; the last day was loaded after it."""
    root, database = scratch_path(spark, "bronze"), f"transit_{uuid.uuid4().hex[:12]}"
    live, path = _live(spark, sf_dir), f"{root}/bronze_live_timetable"
    last = F.col("Ingestion_Date") == F.lit(live.agg(F.max("Ingestion_Date")).first()[0])
    tables.overwrite_partitions(live.filter(~last), path, sort_key=list(BRONZE_LIVE_KEY))
    tables.append_bronze(roles.lines_bronze(roles.table(spark, sf_dir, "part")), f"{root}/bronze_netex_lines")
    tables.append_bronze(roles.quays_bronze_from_documents(roles.table(spark, sf_dir, "documents")), f"{root}/bronze_netex_quays")
    gold_root = scratch_path(spark, "gold")
    model_run.run_models(spark, root, gold_root, database=database)
    tables.overwrite_partitions(live.filter(last), path, sort_key=list(BRONZE_LIVE_KEY))
    other = spark.newSession()
    Database(other, database, gold_root).sync("bronze_live_timetable")
    out = None
    for view in model_run.VIEWS:
        rows = other.table(f"{database}.{view}").withColumn("view", F.lit(view))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


_STATIC_FIELDS = {"topographic_place": "Descriptor", "stop_place": "Name", "quay": "stopPlaceId", "scheduled_stop_point": "PublicCode",
                  "line": "PublicCode", "journey_pattern": "RouteRef", "journey_pattern_stop": "scheduledStopPointRef"}


@register("static_ingest_bronze")
def q_static_ingest_bronze(spark, sf_dir):
    """B: archives of all seven record types -> the seven bronze tables (SNK-1),
    their ids, versions and payloads."""
    landing, root = scratch_path(spark, "netex_landing"), scratch_path(spark, "bronze")

    def t(name):
        return roles.table(spark, sf_dir, name)
    docs = [feeds.topographic_places(t("nation"), t("region")), feeds.stop_places(t("supplier")),
            feeds.scheduled_stop_points(t("part")), feeds.lines(t("part")), feeds.journey_patterns(t("orders")),
            feeds.journey_pattern_stops(t("lineitem"))]
    for n, d in enumerate(docs):
        name = F.concat(F.lit(f"{n}-"), F.col("name"))
        archive.write_files(feeds.zip_archives(d).withColumn("name", name), landing).count()
    static_ingest.ingest_archives(spark, landing, root, roles.RUN1, roles.DAY1)
    # the quay feed repeats the stop places around its quays: a landing folder of its own
    archive.write_files(feeds.zip_archives(feeds.quays(t("lineitem"))), f"{landing}-quays").count()
    static_ingest.ingest_archives(spark, f"{landing}-quays", f"{root}-quays", roles.RUN1, roles.DAY1)
    out = None
    for kind, field in _STATIC_FIELDS.items():
        dataset, table, _ = NETEX_RECORDS[kind]
        rows = tables.read_table(spark, f"{root}{'-quays' if kind == 'quay' else ''}/{table}", BRONZE_NETEX).select(
            "dataset", "id", "version", S.json_extract_string("payload", field).alias("value"),
            S.json_extract_string("payload", "Ingestion_Date").alias("day_ms"))
        out = rows if out is None else out.unionByName(rows)
    return out.filter(F.col("id").isNotNull())


@register("static_reject_replay")
def q_static_reject_replay(spark, sf_dir):
    """SRC-12: a run whose documents are in part cut short, then a replay of the
    repaired archives; bronze is that of a sound run."""
    broken, repaired, root = scratch_path(spark, "netex_landing"), scratch_path(spark, "netex_repaired"), scratch_path(spark, "bronze")
    part = roles.table(spark, sf_dir, "part")
    docs = (feeds.stop_places(roles.table(spark, sf_dir, "supplier")).unionByName(feeds.scheduled_stop_points(part))
            .unionByName(feeds.lines(part)))
    cut = F.expr("substring(content, 1, length(content) div 2)")
    torn = docs.withColumn("content", F.when(F.crc32("path") % 2 == 0, cut).otherwise(F.col("content")))
    archive.write_files(feeds.zip_archives(torn), broken).count()
    archive.write_files(feeds.zip_archives(docs), repaired).count()
    static_ingest.ingest_archives(spark, broken, root, roles.RUN1, roles.DAY1)
    quarantine.replay(spark, repaired, root, roles.RUN1, roles.DAY1)
    out = None
    for kind in ("stop_place", "scheduled_stop_point", "line"):
        bronze = tables.read_table(spark, f"{root}/{NETEX_RECORDS[kind][1]}", BRONZE_NETEX)
        rows = latest_per_key(bronze, BRONZE_NETEX_KEY).select(
            "dataset", "id", "version", S.json_extract_string("payload", _STATIC_FIELDS[kind]).alias("value"),
            S.json_extract_string("payload", "Ingestion_Date").alias("day_ms"))
        out = rows if out is None else out.unionByName(rows)
    return out.filter(F.col("id").isNotNull())


@register("declared_column_tests")
def q_declared_column_tests(spark, sf_dir):
    """The declared not_null / unique tests over all models built from the
    driver tables (live calls from events, lines from parts, quays from documents)."""
    models = model_run.build_models(
        _live(spark, sf_dir), roles.lines_bronze(roles.table(spark, sf_dir, "part")),
        roles.quays_bronze_from_documents(roles.table(spark, sf_dir, "documents")), materialize_silver=True)
    return quality.run_column_tests(models)


@register("src_siri_calls_native")
def q_src_siri_calls_native(spark, sf_dir):
    """SRC-10 through Spark's own XML parser (``from_xml``), no Python."""
    docs = feeds.siri_timetable(roles.table(spark, sf_dir, "events"))
    return siri.to_bronze(siri.calls(siri.extract_native(docs)), roles.RUN1, roles.DAY1)


def _weekend_correction(live):
    """A corrected re-run for weekend days: arrivals a minute later, status
    'corrected', ingested an hour later."""
    weekend = F.dayofweek("Ingestion_Date").isin(1, 7)
    return (live.filter(weekend)
            .withColumns({"ActualArrivalTime": F.timestamp_add("MINUTE", F.lit(1), F.col("ActualArrivalTime")),
                          "ArrivalStatus": F.lit("corrected"),
                          "Ingestion_Timestamp": F.timestamp_add("HOUR", F.lit(1), F.col("Ingestion_Timestamp"))}))


@register("silver_timetable_incremental")
def q_silver_timetable_incremental(spark, sf_dir):
    """Silver maintained per day: a full refresh, then the weekend days are
    re-ingested into bronze and only those silver partitions are recomputed."""
    root, silver_path = scratch_path(spark, "bronze"), scratch_path(spark, "silver_timetable")
    bronze_live = f"{root}/bronze_live_timetable"
    live = _live(spark, sf_dir)
    tables.overwrite_partitions(live, bronze_live, sort_key=list(BRONZE_LIVE_KEY))
    model_run.refresh_silver_timetable(spark, root, silver_path)
    rerun = _weekend_correction(live)
    tables.overwrite_partitions(rerun, bronze_live, sort_key=list(BRONZE_LIVE_KEY))
    days = [r[0] for r in rerun.select("Ingestion_Date").distinct().collect()]   # one row per day
    model_run.refresh_silver_timetable(spark, root, silver_path, days)
    return model_run.read_silver_timetable(spark, silver_path)


@register("fact_movements_incremental")
def q_fact_movements_incremental(spark, sf_dir):
    """WIN-1 maintained: the fact is numbered once, then the weekend days are
    re-ingested, silver refreshed, and the order table changed by what differs."""
    numbered = scratch_path(spark, "numbered")
    _silver_replaced(spark, sf_dir, lambda silver_path: model_run.refresh_numbered_timetable(spark, silver_path, numbered))
    return gold.fact_movements_from_numbered(order_table.read(spark, numbered))


def _silver_replaced(spark, sf_dir, refresh):
    """Silver of all days, ``refresh``, silver of the corrected weekend days, ``refresh``."""
    root, silver_path = scratch_path(spark, "bronze"), scratch_path(spark, "silver_timetable")
    bronze_live, live = f"{root}/bronze_live_timetable", _live(spark, sf_dir)
    tables.overwrite_partitions(live, bronze_live, sort_key=list(BRONZE_LIVE_KEY))
    model_run.refresh_silver_timetable(spark, root, silver_path)
    refresh(silver_path)
    rerun = _weekend_correction(live)
    tables.overwrite_partitions(rerun, bronze_live, sort_key=list(BRONZE_LIVE_KEY))
    days = [r[0] for r in rerun.select("Ingestion_Date").distinct().collect()]   # one row per day
    model_run.refresh_silver_timetable(spark, root, silver_path, days)
    refresh(silver_path)


def _counted(spark, sf_dir) -> dict[str, str]:
    counted = scratch_path(spark, "counted")
    _silver_replaced(spark, sf_dir, lambda silver_path: model_run.refresh_counted_dimensions(spark, silver_path, counted))
    return model_run.counted_paths(counted)


@register("dim_service_journey_incremental")
def q_dim_service_journey_incremental(spark, sf_dir):
    """MDL-8 maintained by counting, over replaced weekend days."""
    return counted_distinct.read(spark, _counted(spark, sf_dir)["service_journeys"])


@register("quay_stops_incremental")
def q_quay_stops_incremental(spark, sf_dir):
    """The timetable's side of MDL-7 maintained by counting, over replaced weekend days."""
    return counted_distinct.read(spark, _counted(spark, sf_dir)["quay_stops"])

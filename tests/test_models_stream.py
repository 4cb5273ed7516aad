"""Gold models (MDL-6..9) edge semantics and the snapshot stream (STR-1)."""

import datetime as dt

from pyspark.sql import functions as F

from kollektiv import feeds, roles
from kollektiv.plans import gold
from kollektiv.schemas import BRONZE_LIVE
from kollektiv.sinks import tables
from kollektiv.sources import archive
from kollektiv.streaming import live as live_stream

SMOKE = "/root/testdata/sf0.001"


def test_dim_quay_unmatched_is_empty_string(spark):
    q = spark.createDataFrame([("Q1", "n", "1,2", "S"), ("Q2", "m", ",", "S"), (None, "x", ",", "S")],
                              "QuayId string, QuayName string, Location string, ParentStopPointId string")
    s = spark.createDataFrame([("Q1", "SP1"), ("Q1", "SP1"), ("Q1", "SP2")], "QuayId string, StopPointId string")
    got = sorted(tuple(r) for r in gold.dim_quay(q, s).collect())
    assert got == [("Q1", "SP1", "n", "1,2", "S"), ("Q1", "SP2", "n", "1,2", "S"), ("Q2", "", "m", ",", "S")]


def test_dim_line_latest_only(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    sl = spark.createDataFrame([("L", "old", "1", "", "", d1), ("L", "new", "1", "", "", d2)],
                               "id string, name string, public_code string, route_id string, direction string, "
                               "Ingestion_Date date")
    assert gold.dim_line(sl).count() == 2                                     # parity (Q3)
    assert [r["name"] for r in gold.dim_line(sl, latest_only=True).collect()] == ["new"]


def test_fact_ids_dense_and_unique(spark):
    from kollektiv.registry import QUERIES
    f = QUERIES["fact_movements"](spark, SMOKE)
    r = f.agg(F.min("event_id"), F.max("event_id"), F.count("*"), F.countDistinct("event_id")).first()
    assert r[0] == 1 and r[1] == r[2] == r[3]


def test_stream_keeps_newest_passing_snapshot_and_never_rolls_back(spark, tmp_path):
    events = roles.table(spark, SMOKE, "events")
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    archive.write_files(feeds.siri_snapshots(events), landing).count()
    report: list = []
    q = live_stream.run_live_stream(spark, landing, bronze, str(tmp_path / "ckpt"), report=report,
                                    max_files_per_trigger=7)
    q.awaitTermination()
    assert q.exception() is None
    failed = {r["snapshot"] for r in report if not r["passed"]}
    assert {r["snapshot"] for r in report if r["snapshot"].endswith("T235930")} <= failed
    newest: dict = {}
    for r in report:
        if r["passed"]:
            newest[r["Ingestion_Date"]] = max(newest.get(r["Ingestion_Date"], r["Ingestion_Timestamp"]),
                                              r["Ingestion_Timestamp"])
    got = tables.read_table(spark, bronze, BRONZE_LIVE)
    per_day = {r["Ingestion_Date"]: (r["n"], r["ts"]) for r in got.groupBy("Ingestion_Date").agg(
        F.countDistinct("Ingestion_Timestamp").alias("n"), F.max("Ingestion_Timestamp").alias("ts")).collect()}
    assert {d: (1, ts) for d, ts in newest.items()} == per_day
    # replaying an old snapshot later must not roll a day back
    ends = {r["snapshot"][:10] for r in report if r["passed"] and r["snapshot"].endswith("T235900")}
    old_label = min(r["snapshot"] for r in report if r["passed"] and r["snapshot"].endswith("T120000")
                    and r["snapshot"][:10] in ends)
    late = str(tmp_path / "late")
    src = tmp_path / "landing" / f"snapshot={old_label}"
    files = [(f"snapshot={old_label}/{p.name}", p.read_bytes()) for p in src.iterdir()]
    archive.write_files(spark.createDataFrame(files, "name string, content binary"), late).count()
    q2 = live_stream.run_live_stream(spark, late, bronze, str(tmp_path / "ckpt2"))
    q2.awaitTermination()
    again = tables.read_table(spark, bronze, BRONZE_LIVE)
    assert again.exceptAll(got).count() == 0 and got.exceptAll(again).count() == 0


def test_stream_equals_one_by_one_batch_loads(spark, tmp_path):
    """The stream's choice (newest passing snapshot per day, across any split
    into micro-batches) equals loading every snapshot in time order with the
    batch job and skipping those that fail the gate."""
    import datetime as dt

    from kollektiv.operators.quality import DataQualityError
    from kollektiv.plans import live_ingest
    events = roles.table(spark, SMOKE, "events").filter(F.dayofmonth("ts") <= 8)   # eight days keep it quick
    landing = tmp_path / "landing"
    archive.write_files(feeds.siri_snapshots(events), str(landing)).count()
    q = live_stream.run_live_stream(spark, str(landing), str(tmp_path / "streamed"), str(tmp_path / "ck"),
                                    max_files_per_trigger=3)
    q.awaitTermination()
    one_by_one = str(tmp_path / "batched")
    for folder in sorted(p.name for p in landing.iterdir()):
        ts = dt.datetime.strptime(folder.split("=", 1)[1], "%Y-%m-%dT%H%M%S")
        docs = archive.read_documents(spark, str(landing / folder))
        try:
            live_ingest.ingest_snapshot(docs, one_by_one, ts, ts.date())
        except DataQualityError:
            pass
    a = tables.read_table(spark, str(tmp_path / "streamed"), BRONZE_LIVE)
    b = tables.read_table(spark, one_by_one, BRONZE_LIVE)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_keeps_silver_current(spark, tmp_path):
    from kollektiv.plans import models
    events = roles.table(spark, SMOKE, "events").filter(F.dayofmonth("ts") <= 6)
    landing = tmp_path / "landing"
    archive.write_files(feeds.siri_snapshots(events), str(landing)).count()
    bronze, silver_path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    q = live_stream.run_live_stream(spark, str(landing), bronze, str(tmp_path / "ck"), max_files_per_trigger=4,
                                    silver_path=silver_path)
    q.awaitTermination()
    assert q.exception() is None
    got = models.read_silver_timetable(spark, silver_path)
    from kollektiv.plans import silver as silver_models
    from kollektiv.plans import staging
    want = silver_models.silver_timetable(staging.stg_live_timetable(tables.read_table(spark, bronze, BRONZE_LIVE)))
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

"""ZIP landing source (SRC-1), sinks (SNK-1..4), static ingest end to end."""

import datetime as dt
import io
import zipfile

import pytest
from conftest import fixture_bytes
from pyspark.sql import functions as F

from kollektiv.operators.dedupe import latest_per_key
from kollektiv.plans import static_ingest
from kollektiv.plans.gold import dim_line
from kollektiv.plans.silver import silver_lines
from kollektiv.plans.staging import stg_netex_lines
from kollektiv.schemas import BRONZE_NETEX, BRONZE_NETEX_KEY
from kollektiv.sinks import tables
from kollektiv.sources import archive, netex

RUN = dt.datetime(2025, 10, 27, 6, 0, 0)
DAY = dt.date(2025, 10, 27)


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    path.write_bytes(buf.getvalue())


def _landing(tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    _zip(land / "a.zip", {"netex/edge.XML": fixture_bytes("netex_edge.xml"), "readme.txt": "x",
                          "cut.xml": "<PublicationDelivery><Line id='cut'>",
                          "more.xml": "<PublicationDelivery><Line id='L9'><Name>Nine</Name></Line></PublicationDelivery>"})
    # a member whose bytes are damaged, in an archive that opens
    _zip(land / "b.zip", {"torn.xml": "<P>" + "<Line id='T'/>" * 500 + "</P>"})
    raw = bytearray((land / "b.zip").read_bytes())
    raw[40:60] = b"\xff" * 20
    (land / "b.zip").write_bytes(raw)
    return land


@pytest.mark.parametrize("whole_bytes", [archive.WHOLE_BYTES, 0, 400])      # whole, by member, both
def test_zip_members(spark, tmp_path, whole_bytes):
    land = _landing(tmp_path)
    m = archive.zip_members(spark, str(land), whole_bytes=whole_bytes, num_partitions=3)
    rows = m.select("member", F.col("error").isNotNull().alias("bad")).collect()
    names = sorted(r["member"] for r in rows if r["member"])
    assert names == ["cut.xml", "more.xml", "netex/edge.XML", "torn.xml"]
    assert sum(r["bad"] for r in rows) == 1               # the damaged member
    lines = netex.records(netex.extract(m), "line").select("id").collect()
    assert sorted(r["id"] for r in lines) == ["L1", "L2", "L9"]
    streamed = netex.extract_landing(spark, str(land), whole_bytes=whole_bytes, num_partitions=3)
    assert streamed.filter("ordinal IS NULL").count() == 0
    assert sorted(r["id"] for r in netex.records(streamed, "line").collect()) == ["L1", "L2", "L9"]
    assert sorted(r["member"] for r in netex.rejects(streamed).collect()) == ["cut.xml", "torn.xml"]


def test_damaged_archives_and_missing_paths_fail(spark, tmp_path):
    land = _landing(tmp_path)
    (land / "broken.zip").write_bytes(b"PK\x03\x04 not really a zip")
    with pytest.raises(Exception, match="BadZipFile"):
        static_ingest.ingest_archives(spark, str(land), str(tmp_path / "bronze"), RUN, DAY)
    assert not (tmp_path / "bronze").exists()
    missing = spark.createDataFrame([(str(tmp_path / "nowhere.zip"),)], "path string")
    with pytest.raises(Exception, match="nowhere.zip"):
        archive.list_members(missing).collect()


def test_stops_that_differ_in_one_flag_keep_their_ids(spark):
    rows = spark.createDataFrame([("J", 1.0, "S", "P", "true", None), ("J", 1.0, "S", "P", "false", None), ("J", 1.0, "S", "P", "true", None)],
                                 "journeyPatternId string, stopOrder double, scheduledStopPointRef string, "
                                 "stopPointInJourneyPatternId string, forBoarding string, forAlighting string")
    ids = static_ingest.stop_ids(rows, rows.columns).select("id").collect()
    assert len(ids) == 2 == len({r["id"] for r in ids})


def test_full_silver_refresh_drops_days_without_silver(spark, tmp_path):
    from kollektiv import roles
    from kollektiv.plans import models
    bronze, silver_path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    live = roles.live_bronze(roles.table(spark, "/root/testdata/sf0.001", "events"))
    tables.overwrite_partitions(live, f"{bronze}/bronze_live_timetable")
    days = models.refresh_silver_timetable(spark, bronze, silver_path)
    lost = days[0]
    gone = live.filter(F.col("Ingestion_Date") == F.lit(lost)).withColumn("ActualArrivalTime", F.lit(None).cast("timestamp_ntz"))
    tables.overwrite_partitions(gone, f"{bronze}/bronze_live_timetable")
    models.refresh_silver_timetable(spark, bronze, silver_path)
    left = models.read_silver_timetable(spark, silver_path)
    assert left.filter(F.col("Ingestion_Date") == F.lit(lost)).count() == 0 < left.count()


def test_stream_waits_for_the_marker(spark, tmp_path):
    from kollektiv.schemas import BRONZE_LIVE
    from kollektiv.streaming import live as live_stream
    land, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    snap = land / "snapshot=2025-10-27T120000"
    snap.mkdir(parents=True)

    def run():
        live_stream.run_live_stream(spark, str(land), bronze, str(tmp_path / "ck"), marker="complete",
                                    verdict_path=str(tmp_path / "verdicts")).awaitTermination()
    (snap / "a.xml").write_text(_siri_doc(2, 0, "A"))
    run()
    assert not (tmp_path / "bronze").exists()
    (snap / "b.xml").write_text(_siri_doc(3, 0, "B"))
    (snap / "complete").write_text("done")
    run()
    got = tables.read_table(spark, bronze, BRONZE_LIVE)
    assert {r["ServiceJourneyId"] for r in got.collect()} == {"A", "B"}
    assert spark.read.parquet(str(tmp_path / "verdicts")).select("rows", "passed").collect() == [(got.count(), True)]


def test_static_ingest_end_to_end(spark, tmp_path):
    land, bronze = _landing(tmp_path), str(tmp_path / "bronze")
    out = static_ingest.ingest_archives(spark, str(land), bronze, RUN, DAY)
    assert out.status == "loaded" and out.rejected_documents == 2      # cut.xml and the damaged member
    assert out.rows["line"] == 3 and out.rows["journey_pattern_stop"] == 5
    lines = tables.read_table(spark, f"{bronze}/bronze_netex_lines", BRONZE_NETEX)
    got = {r["id"]: r["name"] for r in stg_netex_lines(lines).collect()}
    assert got == {"L1": "One", "L2": "Deep", "L9": "Nine"}
    assert [r["line_id"] for r in dim_line(silver_lines(stg_netex_lines(lines))).orderBy("line_id").collect()] == \
        ["L1", "L2", "L9"]
    stops = tables.read_table(spark, f"{bronze}/bronze_netex_journey_pattern_stops", BRONZE_NETEX)
    assert stops.select("id").distinct().count() == 5 and stops.filter("version IS NULL").count() == 5
    first = stops.first()
    assert '"stopOrder"' in first["payload"] and first["dataset"] == "netex_journey_pattern_stops"
    # a second run the same day appends; replace-on-key keeps one row per id
    static_ingest.ingest_archives(spark, str(land), bronze, RUN + dt.timedelta(hours=1), DAY)
    lines = tables.read_table(spark, f"{bronze}/bronze_netex_lines", BRONZE_NETEX)
    assert lines.count() == 6 and latest_per_key(lines, BRONZE_NETEX_KEY).count() == 3


def test_static_ingest_duplicate_line_ids_fail_before_write(spark, tmp_path):
    land = tmp_path / "dup"
    land.mkdir()
    doc = "<P><Line id='X'/><Line id='X'/></P>"
    _zip(land / "d.zip", {"a.xml": doc})
    import pytest
    from kollektiv.operators.quality import DataQualityError
    with pytest.raises(DataQualityError):
        static_ingest.ingest_archives(spark, str(land), str(tmp_path / "bronze"), RUN, DAY)
    assert not (tmp_path / "bronze").exists()


def test_positional_stop_ids(spark, tmp_path):
    land, bronze = _landing(tmp_path), str(tmp_path / "bronze")
    static_ingest.ingest_archives(spark, str(land), bronze, RUN, DAY, stop_id_mode="position")
    stops = tables.read_table(spark, f"{bronze}/bronze_netex_journey_pattern_stops", BRONZE_NETEX)
    assert sorted(r["id"] for r in stops.collect()) == ["0", "1", "2", "3", "4"]


def test_positional_ids_keep_first_of_duplicates(spark):
    doc = ("<P><JourneyPattern id='J'><StopPointInJourneyPattern id='A' order='1'/>"
           "<StopPointInJourneyPattern id='B' order='2'/><StopPointInJourneyPattern id='A' order='1'/>"
           "<StopPointInJourneyPattern id='C' order='3'/></JourneyPattern></P>")
    from conftest import docs_frame
    tagged = netex.extract(docs_frame(spark, [("d.xml", doc)]), record_types=("journey_pattern_stop",))
    rows = netex.records(tagged, "journey_pattern_stop", with_source=True)
    fields = [c for c in rows.columns if c not in ("path", "member", "seq")]
    got = sorted((r["stopPointInJourneyPatternId"], r["id"])
                 for r in static_ingest.stop_ids(rows, fields, "position").collect())
    assert got == [("A", "0"), ("B", "1"), ("C", "3")]            # duplicate dropped, gap kept
    hashed = static_ingest.stop_ids(rows, fields, "hash")
    assert hashed.count() == 3 and hashed.select("id").distinct().count() == 3


def test_overwrite_partitions_only_touches_given_days(spark, tmp_path):
    path = str(tmp_path / "t")
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    df = spark.createDataFrame([("a", d1), ("b", d2)], "v string, Ingestion_Date date")
    tables.overwrite_partitions(df, path)
    tables.overwrite_partitions(spark.createDataFrame([("c", d2)], "v string, Ingestion_Date date"), path)
    tables.overwrite_partitions(spark.createDataFrame([], "v string, Ingestion_Date date"), path)
    got = sorted((r["v"], r["Ingestion_Date"]) for r in tables.read_table(spark, path).collect())
    assert got == [("a", d1), ("c", d2)]


def test_publish_table_swaps_and_can_read_itself(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.publish_table(spark.createDataFrame([(1,), (2,)], "x int"), path)
    tables.publish_table(tables.read_table(spark, path).withColumn("x", F.col("x") * 10), path)
    assert sorted(r["x"] for r in tables.read_table(spark, path).collect()) == [10, 20]
    assert [p.name for p in tmp_path.iterdir()] == ["gold"]


def test_publish_view(spark):
    tables.publish_view(spark.createDataFrame([(1,)], "x int"), "kollektiv_view_test")
    assert spark.sql("SELECT x FROM kollektiv_view_test").first()[0] == 1


def test_jobs_cli_static_then_models(tmp_path, spark):
    from kollektiv import jobs
    from kollektiv.schemas import BRONZE_LIVE
    land, bronze, gold = _landing(tmp_path), str(tmp_path / "bronze"), str(tmp_path / "gold")
    # jobs.main reuses the active session and stops it at the end: keep the test session alive
    orig_stop = spark.stop
    spark.stop = lambda: None
    try:
        assert jobs.main(["static", "--landing", str(land), "--bronze", bronze, "--date", "2025-10-27",
                          "--ts", "2025-10-27T06:00:00"]) == 0
        tables.overwrite_partitions(spark.createDataFrame([], BRONZE_LIVE), f"{bronze}/bronze_live_timetable")
        assert jobs.main(["models", "--bronze", bronze, "--gold", gold]) == 0
    finally:
        spark.stop = orig_stop
    got = sorted(r["line_id"] for r in tables.read_table(spark, f"{gold}/dim_line").collect())
    assert got == ["L1", "L2", "L9"]


def test_staging_scope_drops_its_tables(spark, tmp_path):
    import os

    from kollektiv.session import stage_table, staging_scope
    with staging_scope(spark) as scope:
        t = stage_table(spark.range(5), "scope-test")
        assert t.count() == 5
        paths = list(scope.paths)
    assert paths and not any(os.path.exists(p.replace("file:", "", 1)) for p in paths)


def _siri_doc(n_arrived, n_missing, journey="J"):
    calls = "".join(
        f"<RecordedCall><StopPointRef>Q{i}</StopPointRef><AimedArrivalTime>2025-10-27T10:00:00Z</AimedArrivalTime>"
        + ("<ActualArrivalTime>2025-10-27T10:01:00Z</ActualArrivalTime>" if i < n_arrived else "")
        + "</RecordedCall>" for i in range(n_arrived + n_missing))
    return ("<Siri xmlns='http://www.siri.org.uk/siri'><ServiceDelivery><EstimatedTimetableDelivery>"
            "<EstimatedJourneyVersionFrame><EstimatedVehicleJourney><FramedVehicleJourneyRef>"
            f"<DataFrameRef>2025-10-27</DataFrameRef><DatedVehicleJourneyRef>{journey}</DatedVehicleJourneyRef>"
            f"</FramedVehicleJourneyRef><RecordedCalls>{calls}</RecordedCalls></EstimatedVehicleJourney>"
            "</EstimatedJourneyVersionFrame></EstimatedTimetableDelivery></ServiceDelivery></Siri>")


def test_jobs_cli_live_and_stream(tmp_path, spark):
    from kollektiv import jobs
    from kollektiv.schemas import BRONZE_LIVE
    land = tmp_path / "live"
    land.mkdir()
    (land / "snap.xml").write_text(_siri_doc(3, 1))
    snaps = tmp_path / "snaps"
    (snaps / "snapshot=2025-10-27T120000").mkdir(parents=True)
    (snaps / "snapshot=2025-10-27T120000" / "a.xml").write_text(_siri_doc(1, 0, "A"))
    (snaps / "snapshot=2025-10-27T235900").mkdir()
    (snaps / "snapshot=2025-10-27T235900" / "b.xml").write_text(_siri_doc(2, 0, "B"))
    (snaps / "snapshot=2025-10-27T235930").mkdir()
    (snaps / "snapshot=2025-10-27T235930" / "c.xml").write_text(_siri_doc(0, 5, "C"))     # fails the gate
    orig_stop = spark.stop
    spark.stop = lambda: None
    try:
        b1, b2 = str(tmp_path / "b1"), str(tmp_path / "b2")
        assert jobs.main(["live", "--landing", str(land), "--bronze", b1, "--date", "2025-10-27",
                          "--ts", "2025-10-27T10:05:00"]) == 0
        assert jobs.main(["live", "--landing", str(land), "--bronze", b1, "--date", "2025-10-28", "--native"]) == 0
        assert jobs.main(["stream", "--landing", str(snaps), "--bronze", b2,
                          "--checkpoint", str(tmp_path / "ck"), "--once"]) == 0
    finally:
        spark.stop = orig_stop
    live = tables.read_table(spark, f"{b1}/bronze_live_timetable", BRONZE_LIVE)
    assert live.count() == 8 and live.select("Ingestion_Date").distinct().count() == 2
    got = tables.read_table(spark, f"{b2}/bronze_live_timetable", BRONZE_LIVE).collect()
    assert {r["ServiceJourneyId"] for r in got} == {"B"} and len(got) == 2


def test_jobs_cli_silver(tmp_path, spark):
    from kollektiv import jobs, roles
    from kollektiv.plans.models import read_silver_timetable
    bronze = tmp_path / "bronze"
    tables.overwrite_partitions(roles.live_bronze(roles.table(spark, "/root/testdata/sf0.001", "events")),
                                str(bronze / "bronze_live_timetable"))
    orig_stop = spark.stop
    spark.stop = lambda: None
    try:
        assert jobs.main(["silver", "--bronze", str(bronze), "--silver", str(tmp_path / "silver")]) == 0
        assert jobs.main(["silver", "--bronze", str(bronze), "--silver", str(tmp_path / "silver"),
                          "--days", "2024-01-02,2024-01-03"]) == 0
    finally:
        spark.stop = orig_stop
    assert read_silver_timetable(spark, str(tmp_path / "silver")).count() > 0


def test_stream_skips_snapshot_with_malformed_file(tmp_path, spark):
    from kollektiv.schemas import BRONZE_LIVE
    from kollektiv.streaming import live as live_stream
    snaps = tmp_path / "snaps"
    good, broken = snaps / "snapshot=2025-10-27T120000", snaps / "snapshot=2025-10-27T180000"
    good.mkdir(parents=True)
    broken.mkdir()
    (good / "a.xml").write_text(_siri_doc(2, 0, "G"))
    (broken / "a.xml").write_text(_siri_doc(3, 0, "X"))
    (broken / "b.xml").write_text("<Siri xmlns='http://www.siri.org.uk/siri'><ServiceDelivery>")   # cut short
    report: list = []
    q = live_stream.run_live_stream(spark, str(snaps), str(tmp_path / "bronze"), str(tmp_path / "ck"),
                                    report=report)
    q.awaitTermination()
    assert q.exception() is None
    verdicts = {r["snapshot"]: (r["passed"], r["rejected_files"]) for r in report}
    assert verdicts == {"2025-10-27T120000": (True, 0), "2025-10-27T180000": (False, 1)}
    got = tables.read_table(spark, str(tmp_path / "bronze"), BRONZE_LIVE).collect()
    assert {r["ServiceJourneyId"] for r in got} == {"G"}


def test_jobs_cli_declared_tests(tmp_path, spark, capsys):
    import json

    from kollektiv import jobs, roles
    from kollektiv.schemas import BRONZE_NETEX
    bronze = tmp_path / "bronze"
    tables.overwrite_partitions(roles.live_bronze(roles.table(spark, "/root/testdata/sf0.001", "events")),
                                str(bronze / "bronze_live_timetable"))
    tables.append_bronze(roles.lines_bronze(roles.table(spark, "/root/testdata/sf0.001", "part")),
                         str(bronze / "bronze_netex_lines"))
    tables.append_bronze(spark.createDataFrame([], BRONZE_NETEX), str(bronze / "bronze_netex_quays"))
    orig_stop = spark.stop
    spark.stop = lambda: None
    try:
        code = jobs.main(["test", "--bronze", str(bronze)])
    finally:
        spark.stop = orig_stop
    results = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 1 and len(results) == 17                 # known failures make the run fail
    status = {(r["model"], r["column_name"], r["test"]): r["status"] for r in results}
    assert status[("dim_line", "line_id", "unique")] == "fail"
    assert status[("fact_movements", "event_id", "unique")] == "pass"
    assert status[("silver_lines", "LineId", "not_null")] == "error"


def test_staged_records_are_read_by_type_folder(spark, tmp_path):
    from kollektiv.session import staging_scope
    land = _landing(tmp_path)
    with staging_scope(spark):
        tagged = static_ingest.stage_records(netex.extract_landing(spark, str(land)))
        lines = netex.records(tagged, "line")
        plan = lines._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        assert "PartitionFilters: [isnotnull(record_type" in plan and "= line)" in plan
        assert sorted(r["id"] for r in lines.collect()) == ["L1", "L2", "L9"]

"""Snapshots that land over time are read once and whole (STR-1), without a marker."""

import os
import time

import pytest

from kollektiv.schemas import BRONZE_LIVE
from kollektiv.sinks import tables
from kollektiv.streaming import live as live_stream

SETTLE = 15.0


def _document(quay: str) -> str:
    return ("<Siri xmlns='http://www.siri.org.uk/siri'><EstimatedVehicleJourney><FramedVehicleJourneyRef>"
            f"<DatedVehicleJourneyRef>J</DatedVehicleJourneyRef></FramedVehicleJourneyRef><RecordedCalls>"
            f"<RecordedCall><StopPointRef>{quay}</StopPointRef><Order>1</Order>"
            "<AimedArrivalTime>2025-10-27T10:00:00Z</AimedArrivalTime>"
            "<ActualArrivalTime>2025-10-27T10:01:00Z</ActualArrivalTime></RecordedCall>"
            "</RecordedCalls></EstimatedVehicleJourney></Siri>")


def _land(folder, numbers):
    folder.mkdir(parents=True, exist_ok=True)
    for i in numbers:
        part = folder / f".{i}.tmp"
        part.write_text(_document(f"Q{i}"))
        part.rename(folder / f"{i}.xml")


def _wait(q, done, seconds):
    end = time.time() + seconds
    while time.time() < end and not done():
        assert q.exception() is None
        time.sleep(0.2)
    assert q.exception() is None
    return done()


def _quays(spark, bronze):
    if not os.path.isdir(f"{bronze}/_versions"):
        return []
    return sorted(r["QuayId"] for r in tables.read_table(spark, bronze, BRONZE_LIVE).select("QuayId").collect())


def _start(spark, tmp_path, report, **more):
    return live_stream.run_live_stream(spark, str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ck"),
                                       available_now=False, processing_time="1 second", report=report,
                                       settle_seconds=SETTLE, **more)


def test_a_snapshot_that_lands_in_two_steps_is_read_once_and_whole(spark, tmp_path):
    snap, report = tmp_path / "landing" / "snapshot=2025-10-27T120000", []
    _land(snap, range(800))
    (tmp_path / "landing" / "loose.xml").write_text(_document("LOOSE"))     # in no snapshot: passed over
    q = _start(spark, tmp_path, report)                                     # 1,000 files a trigger
    try:
        assert _wait(q, lambda: any(p.numInputRows for p in q.recentProgress), 60)
        assert report == []
        _land(snap, range(800, 1500))
        want = sorted(f"Q{i}" for i in range(1500))
        assert _wait(q, lambda: _quays(spark, str(tmp_path / "bronze")) == want, 120)
        time.sleep(3)                                                       # a second reading would come now
    finally:
        q.stop()
    assert [(r["snapshot"], r["rows"], r["passed"]) for r in report] == [("2025-10-27T120000", 1500, True)]


def test_half_a_snapshot_outlives_a_restart_and_a_late_file_opens_it_again(spark, tmp_path):
    snap, report = tmp_path / "landing" / "snapshot=2025-10-27T120000", []
    _land(snap, range(3))
    q = _start(spark, tmp_path, report)
    assert _wait(q, lambda: any(p.numInputRows for p in q.recentProgress), 60)
    q.stop()                                                                # three files are in the state only
    assert report == []
    _land(snap, [3])
    _land(tmp_path / "landing" / "snapshot=2025-10-28T120000", [7])
    q = _start(spark, tmp_path, report)
    try:
        assert _wait(q, lambda: len(report) >= 2, 90)
        assert sorted((r["snapshot"], r["rows"]) for r in report) == [("2025-10-27T120000", 4), ("2025-10-28T120000", 1)]
        report.clear()
        _land(snap, [4])                                                    # later than the time-out
        assert _wait(q, lambda: _quays(spark, str(tmp_path / "bronze")) == ["Q0", "Q1", "Q2", "Q3", "Q4", "Q7"], 90)
    finally:
        q.stop()
    assert [(r["snapshot"], r["rows"]) for r in report] == [("2025-10-27T120000", 5)]


def test_settling_is_for_running_streams(spark, tmp_path):
    with pytest.raises(ValueError, match="running stream"):
        live_stream.run_live_stream(spark, "l", "b", str(tmp_path / "ck"), settle_seconds=5.0)

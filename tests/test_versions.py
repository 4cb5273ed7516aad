"""Versioned tables: readers see whole versions, writers merge, old ones go."""

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from kollektiv.sinks import tables, versions

DAYS = [dt.date(2025, 1, d) for d in (1, 2, 3)]
SCHEMA = "v int, Ingestion_Date date"


def day_rows(spark, v, days=DAYS, n=4):
    return spark.createDataFrame([(v, d) for d in days for _ in range(n)], SCHEMA)


def test_a_reader_never_sees_a_missing_or_mixed_table(spark, tmp_path):
    """A reader loops during 20 publishes of a table and of three days."""
    gold, days = str(tmp_path / "gold"), str(tmp_path / "days")
    tables.publish_table(spark.range(6).select(F.lit(0).alias("v")), gold)
    tables.overwrite_partitions(day_rows(spark, 0), days)
    seen, wrong, done = set(), [], threading.Event()

    def loop():
        while not done.is_set():
            try:
                a = [r.v for r in tables.read_table(spark, gold).collect()]
                b = [(r.v, r.Ingestion_Date) for r in tables.read_table(spark, days).collect()]
            except Exception as e:  # noqa: BLE001
                wrong.append(repr(e))
                return
            if len(a) != 6 or len(set(a)) != 1 or len(b) != 12 or len({v for v, _ in b}) != 1:
                wrong.append((a, b))
            seen.update(a)
    reader = threading.Thread(target=loop)
    reader.start()
    try:
        for i in range(1, 21):
            tables.publish_table(spark.range(6).select(F.lit(i).alias("v")), gold)
            tables.overwrite_partitions(day_rows(spark, i), days)
    finally:
        done.set()
        reader.join()
    assert not wrong and len(seen) > 1
    assert versions.current(spark, gold)["version"] == versions.current(spark, days)["version"] == 21


def test_days_replaced_added_and_ended_in_one_step(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(day_rows(spark, 1), path)
    tables.overwrite_partitions(day_rows(spark, 2, [DAYS[1], dt.date(2025, 1, 9)]), path, gone=[DAYS[0]])
    got = {(r.v, r.Ingestion_Date) for r in tables.read_table(spark, path).collect()}
    assert got == {(2, DAYS[1]), (1, DAYS[2]), (2, dt.date(2025, 1, 9))}
    assert versions.days_of(spark, path, "Ingestion_Date") == {DAYS[1], DAYS[2], dt.date(2025, 1, 9)}
    before = tables.read_table(spark, path).count()
    tables.overwrite_partitions(day_rows(spark, 3, []), path)                       # nothing in it: nothing changes
    assert tables.read_table(spark, path).count() == before and versions.current(spark, path)["version"] == 2
    old = versions.read(spark, path, version=1)
    assert {r.v for r in old.collect()} == {1} and old.count() == 12
    with pytest.raises(ValueError):
        versions.current(spark, path, 7)


def test_a_day_filter_reads_that_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(day_rows(spark, 1), path)
    tables.overwrite_partitions(day_rows(spark, 2, DAYS[:1]), path)
    df = tables.read_table(spark, path).filter(F.col("Ingestion_Date") == DAYS[2])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Ingestion_Date" in plan and df.count() == 4
    assert df.columns == ["v", "Ingestion_Date"]


def test_an_empty_table_has_its_columns(spark, tmp_path):
    for path in (str(tmp_path / "a"), str(tmp_path / "b")):
        (tables.publish_table if path.endswith("a") else tables.overwrite_partitions)(spark.createDataFrame([], SCHEMA), path)
        df = tables.read_table(spark, path)
        assert df.columns == ["v", "Ingestion_Date"] and df.count() == 0


def test_days_without_manifests_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    day_rows(spark, 1).write.partitionBy("Ingestion_Date").parquet(path)
    assert tables.read_table(spark, path).count() == 12                             # plain folder
    tables.overwrite_partitions(day_rows(spark, 2, DAYS[:1]), path)
    got = sorted({(r.Ingestion_Date, r.v) for r in tables.read_table(spark, path).collect()})
    assert got == [(DAYS[0], 2), (DAYS[1], 1), (DAYS[2], 1)]
    tables.overwrite_partitions(day_rows(spark, 3), path)
    assert {r.v for r in tables.read_table(spark, path).collect()} == {3}


def test_two_writers_of_different_days_lose_nothing(spark, tmp_path, monkeypatch):
    """The other writer publishes between this one's look and its commit."""
    path = str(tmp_path / "t")
    tables.overwrite_partitions(day_rows(spark, 1, DAYS[:1]), path)
    real, raced = versions.Store.create, []

    def create(self, name, text):
        if not raced:
            raced.append(name)
            tables.overwrite_partitions(day_rows(spark, 2, DAYS[1:2]), path)
        return real(self, name, text)
    monkeypatch.setattr(versions.Store, "create", create)
    tables.overwrite_partitions(day_rows(spark, 3, DAYS[2:]), path)
    assert {(r.Ingestion_Date, r.v) for r in tables.read_table(spark, path).collect()} == {(DAYS[0], 1), (DAYS[1], 2), (DAYS[2], 3)}
    assert versions.current(spark, path)["version"] == 3


def test_unfinished_manifests_are_passed_over(spark, tmp_path):
    path = tmp_path / "t"
    tables.publish_table(spark.range(3).toDF("v"), str(path))
    (path / "_versions" / f"{2:020d}.json").write_text('{"version": 2, "fold')
    assert tables.read_table(spark, str(path)).count() == 3
    tables.publish_table(spark.range(5).toDF("v"), str(path))
    assert versions.current(spark, str(path))["version"] == 3 and tables.read_table(spark, str(path)).count() == 5


def test_a_failed_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_table(spark.range(3).toDF("v"), path)
    with pytest.raises(Exception, match="(?i)division|divide"):
        tables.publish_table(spark.range(3).selectExpr("id / (id - 1) AS v"), path)
    assert tables.read_table(spark, path).count() == 3


def test_vacuum_keeps_what_is_used_or_being_written(spark, tmp_path):
    root = tmp_path / "t"
    path = str(root)
    for i in range(5):
        tables.overwrite_partitions(day_rows(spark, i, DAYS if i == 0 else DAYS[:1]), path)
    loading = root / "data" / "batch=loading" / "Ingestion_Date=2025-01-01"
    loading.mkdir(parents=True)
    assert versions.vacuum(spark, path, keep=2) == []                               # too young
    held = tables.read_table(spark, path)
    removed = versions.vacuum(spark, path, keep=2, seconds=0)
    # days 2 and 3 of the first load are still the table's
    assert len(removed) == 3 and loading.exists()
    assert held.count() == tables.read_table(spark, path).count() == 12
    kept = [json.loads(p.read_text())["version"] for p in (root / "_versions").glob("*.json")]
    assert sorted(kept) == [4, 5]

"""DISTINCT maintained by counting equals a rebuild under inserts, replaced and emptied days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kollektiv import roles
from kollektiv.operators import counted_distinct
from kollektiv.sinks import tables, versions

SMOKE = "/root/testdata/sf0.001"
SCHEMA = "a string, b int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_supports_rise_fall_and_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counted_distinct, "BUCKET_ROWS", 4)
    path = str(tmp_path / "t")
    rows = [("hot", 1)] * 50 + [(None, None)] * 2 + [(f"k{i}", i % 3) for i in range(20)]
    counted_distinct.build(frame(spark, rows), path)
    changes = [([("hot", 1)] * 49 + [(None, None)], [("new", None)]), ([("hot", 1), ("k3", 0)], [("k3", 0)]),
               ([(None, None), ("new", None)], [(None, 1)] * 2), ([], [])]
    for leaving, coming in changes:
        for r in leaving:
            rows.remove(r)
        rows += coming
        counted_distinct.change(spark, path, frame(spark, leaving), frame(spark, coming))
        assert rows_of(counted_distinct.read(spark, path)) == sorted(set(rows), key=repr)
    with pytest.raises(ValueError):
        counted_distinct.change(spark, path, frame(spark, [("hot", 1)]), frame(spark, []))
    assert rows_of(counted_distinct.read(spark, path)) == sorted(set(rows), key=repr)


def test_equal_days_write_nothing_and_other_buckets_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counted_distinct, "BUCKET_ROWS", 4)
    path, rows = str(tmp_path / "t"), [(f"k{i}", i) for i in range(40)]
    counted_distinct.build(frame(spark, rows), path)
    before = versions.current(spark, path)["folders"]
    same = counted_distinct.change(spark, path, frame(spark, rows[:30]), frame(spark, rows[:30]))
    assert same.buckets_written == same.rows_changed == 0 and versions.current(spark, path)["folders"] == before
    one = counted_distinct.change(spark, path, frame(spark, rows[:1]), frame(spark, []))
    after = versions.current(spark, path)["folders"]
    assert one.rows_changed == 1 and len(set(before.items()) - set(after.items())) == 1
    plan = counted_distinct.read(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_an_empty_input_and_all_rows_leaving(spark, tmp_path):
    path = str(tmp_path / "t")
    counted_distinct.build(frame(spark, []), path)
    assert rows_of(counted_distinct.read(spark, path)) == []
    counted_distinct.change(spark, path, frame(spark, []), frame(spark, [("a", 1)]))
    counted_distinct.change(spark, path, frame(spark, [("a", 1)]), frame(spark, []))
    assert rows_of(counted_distinct.read(spark, path)) == []


def test_model_run_over_maintained_tables_equals_a_full_run(spark, tmp_path):
    """Corrected, emptied and new days; then numbers and dimensions from the
    maintained tables, which a run refuses while they are behind silver."""
    from kollektiv.plans import models
    root, silver_path = tmp_path / "bronze", str(tmp_path / "silver")
    numbered, counted, bronze = str(tmp_path / "numbered"), str(tmp_path / "counted"), str(root / "bronze_live_timetable")
    live = roles.live_bronze(roles.table(spark, SMOKE, "events"))
    tables.overwrite_partitions(live, bronze)
    tables.append_bronze(roles.lines_bronze(roles.table(spark, SMOKE, "part")), str(root / "bronze_netex_lines"))
    tables.append_bronze(roles.quays_bronze_from_documents(roles.table(spark, SMOKE, "documents")), str(root / "bronze_netex_quays"))
    models.refresh_silver_timetable(spark, str(root), silver_path)
    models.refresh_numbered_timetable(spark, silver_path, numbered)
    models.refresh_counted_dimensions(spark, silver_path, counted)
    days = sorted(r[0] for r in models.read_silver_timetable(spark, silver_path).select("Ingestion_Date").distinct().collect())
    new_day = dt.date(2031, 1, 1)
    corrected = live.filter(F.col("Ingestion_Date") == days[0]).withColumn("LineId", F.concat(F.col("LineId"), F.lit("-b")))
    emptied = live.filter(F.col("Ingestion_Date") == days[1]).withColumn("ActualArrivalTime", F.lit(None).cast("timestamp_ntz"))
    added = live.filter(F.col("Ingestion_Date") == days[2]).withColumn("Ingestion_Date", F.lit(new_day))
    tables.overwrite_partitions(corrected.unionByName(emptied).unionByName(added), bronze)
    models.refresh_silver_timetable(spark, str(root), silver_path, [days[0], days[1], new_day])
    with pytest.raises(ValueError):
        models.run_models(spark, str(root), str(tmp_path / "late"), silver_path=silver_path, numbered_path=numbered)
    models.refresh_numbered_timetable(spark, silver_path, numbered)
    models.refresh_counted_dimensions(spark, silver_path, counted)
    a = models.run_models(spark, str(root), str(tmp_path / "gold_a"))
    b = models.run_models(spark, str(root), str(tmp_path / "gold_b"), silver_path=silver_path, numbered_path=numbered, counted_root=counted)
    for name in models.TABLES:
        x, y = tables.read_table(spark, a[name]), tables.read_table(spark, b[name])
        assert x.columns == y.columns and x.count() > 0
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name

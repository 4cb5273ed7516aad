"""WIN-1 maintained: numbers equal a full renumbering, only changed ranges are read and written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kollektiv import roles
from kollektiv.operators import order_table
from kollektiv.operators.ids import dense_row_number
from kollektiv.sinks import tables, versions

SMOKE = "/root/testdata/sf0.001"
ORDER = ("k", "t")
SCHEMA = "k string, t int, v string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def whole(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return rows_of(dense_row_number(df, [F.col(c).asc_nulls_last() for c in ("k", "t", "v")], "event_id").select("k", "t", "v", "event_id"))


def numbered(spark, path):
    return rows_of(order_table.read(spark, path).select("k", "t", "v", "event_id"))


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(order_table, "RANGE_ROWS", 10)


def start(spark, path):
    rows = [(f"k{i % 9}" if i % 11 else None, i, "x") for i in range(200)] + [("hot", i, None) for i in range(100)]
    order_table.build(spark.createDataFrame(rows, SCHEMA), path, ORDER, {"source_version": 1})
    return rows


def test_a_series_of_changes_equals_a_full_renumbering(spark, tmp_path, small_ranges):
    path = str(tmp_path / "t")
    rows = start(spark, path)
    assert numbered(spark, path) == whole(spark, rows)
    # rows in the middle; before all and after all; a whole range leaves; a hot key grows beyond a cut
    changes = [([r for r in rows if r[0] == "k3"][:3], [("k3", 1000, "y"), ("k3", None, "y")]),
               ([], [("a", i, "z") for i in range(4)] + [(None, None, None)]),
               ([r for r in rows if r[0] in ("k0", "k1")], []),
               ([], [("hot", 50, f"n{i:03}") for i in range(95)])]
    for leaving, coming in changes:
        rows = [r for r in rows if r not in leaving] + coming
        done = order_table.change(spark, path, spark.createDataFrame(leaving, SCHEMA), spark.createDataFrame(coming, SCHEMA), ORDER)
        assert numbered(spark, path) == whole(spark, rows)
        assert done.ranges == len(versions.current(spark, path)["folders"])
    sizes = order_table.read(spark, path).count()
    assert sizes == len(rows)
    biggest = versions.read(spark, path).groupBy(order_table.RANGE).count().agg(F.max("count")).first()[0]
    assert biggest <= 2 * order_table.RANGE_ROWS


def test_other_ranges_keep_their_files_and_are_not_read(spark, tmp_path, small_ranges, monkeypatch):
    path, read = str(tmp_path / "t"), []
    start(spark, path)
    before = versions.current(spark, path)["folders"]
    real = order_table.range_rows

    def spy(*a):
        out = real(*a)
        read.extend(out.inputFiles())
        return out
    monkeypatch.setattr(order_table, "range_rows", spy)
    done = order_table.change(spark, path, spark.createDataFrame([], SCHEMA), spark.createDataFrame([("k5", 3000, "q")], SCHEMA), ORDER)
    after = versions.current(spark, path)["folders"]
    moved = [r for r in before if after[r] != before[r]]
    assert len(moved) == 1 == done.ranges_written and done.rows_written == 11
    assert read and all(f"{order_table.RANGE}={moved[0]}/" in f for f in read)
    plan = order_table.read(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_emptied_refilled_and_empty_changes(spark, tmp_path, small_ranges):
    path, none = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA)
    order_table.build(none, path, ORDER)
    assert numbered(spark, path) == []
    some = [("b", 1, "x"), (None, 2, "y"), ("a", None, None)]
    order_table.change(spark, path, none, spark.createDataFrame(some, SCHEMA), ORDER)
    assert numbered(spark, path) == whole(spark, some)
    done = order_table.change(spark, path, none, none, ORDER, {"source_version": 7})
    assert numbered(spark, path) == whole(spark, some) and done.ranges_written == 0
    assert versions.current(spark, path)["notes"] == {"source_version": 7}
    order_table.change(spark, path, spark.createDataFrame(some, SCHEMA), none, ORDER)
    assert numbered(spark, path) == []


def test_wrong_changes_are_refused_and_publish_nothing(spark, tmp_path, small_ranges):
    path, none = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA)
    rows = start(spark, path)
    with pytest.raises(ValueError):                                                  # a row it does not hold
        order_table.change(spark, path, spark.createDataFrame([("k5", 9999, "q")], SCHEMA), none, ORDER)
    with pytest.raises(ValueError):                                                  # a row it holds already
        order_table.change(spark, path, none, spark.createDataFrame(rows[5:6], SCHEMA), ORDER)
    assert versions.current(spark, path)["version"] == 1 and numbered(spark, path) == whole(spark, rows)


def test_a_second_writer_gets_a_conflict(spark, tmp_path, small_ranges):
    path = str(tmp_path / "t")
    rows = start(spark, path)
    with pytest.raises(versions.Conflict):
        order_table.build(spark.createDataFrame(rows[:3], SCHEMA), path, ORDER, expect=0)
    assert numbered(spark, path) == whole(spark, rows)


def test_statistics_go_with_their_version(spark, tmp_path, small_ranges):
    path, none = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA)
    start(spark, path)
    first = versions.current(spark, path)["attached"][0]
    for i in range(3):
        order_table.change(spark, path, none, spark.createDataFrame([("k5", 3000 + i, "q")], SCHEMA), ORDER)
    removed = versions.vacuum(spark, path, keep=1, seconds=0)
    assert first in removed and not (tmp_path / "t" / first).exists()
    assert len(numbered(spark, path)) == 303


def test_timetable_after_three_daily_changes_equals_a_full_fact(spark, tmp_path):
    from kollektiv.plans import gold, models
    root, silver_path, path = tmp_path / "bronze", str(tmp_path / "silver"), str(tmp_path / "numbered")
    live = roles.live_bronze(roles.table(spark, SMOKE, "events"))
    bronze = str(root / "bronze_live_timetable")
    tables.overwrite_partitions(live, bronze)
    models.refresh_silver_timetable(spark, str(root), silver_path)
    models.refresh_numbered_timetable(spark, silver_path, path)
    days = sorted(r[0] for r in models.read_silver_timetable(spark, silver_path).select("Ingestion_Date").distinct().collect())
    later = F.timestamp_add("MINUTE", F.lit(1), "ActualArrivalTime")
    changes = [(days[0], {"ActualArrivalTime": later}),                                        # corrected
               (days[1], {"ActualArrivalTime": F.lit(None).cast("timestamp_ntz")}),            # emptied
               (dt.date(2031, 1, 1), {"Ingestion_Date": F.lit(dt.date(2031, 1, 1))})]          # new
    for day, new in changes:
        source = live.filter(F.col("Ingestion_Date") == (days[2] if day.year == 2031 else day))
        tables.overwrite_partitions(source.withColumns(new), bronze)
        models.refresh_silver_timetable(spark, str(root), silver_path, [day])
        models.refresh_numbered_timetable(spark, silver_path, path)
        got = gold.fact_movements_from_numbered(order_table.read(spark, path))
        want = gold.fact_movements(models.read_silver_timetable(spark, silver_path))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert models.refresh_numbered_timetable(spark, silver_path, path).rows_written == 0      # nothing new

"""Published names: views equal the DataFrame models, in other sessions too."""

import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

from kollektiv import roles
from kollektiv.plans import models
from kollektiv.schemas import BRONZE_LIVE_KEY
from kollektiv.sinks import tables
from kollektiv.sinks.catalog import Database

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def bronze(spark, root):
    live = roles.live_bronze(roles.table(spark, SMOKE, "events"))
    again = live.limit(40).withColumn("Ingestion_Timestamp", F.col("Ingestion_Timestamp") + F.expr("INTERVAL 1 HOUR")) \
        .withColumn("ArrivalStatus", F.lit("late"))
    tables.overwrite_partitions(live.unionByName(again), f"{root}/bronze_live_timetable", sort_key=list(BRONZE_LIVE_KEY))
    part = roles.table(spark, SMOKE, "part")
    for rows in (roles.lines_run(part, F.col("p_name"), roles.RUN1, roles.DAY1), roles.lines_run(part, roles.renamed_lines(), roles.RUN2, roles.DAY1),
                 roles.lines_run(part, roles.renamed_lines(), roles.RUN3, roles.DAY2)):
        tables.append_bronze(rows, f"{root}/bronze_netex_lines")
    tables.append_bronze(roles.quays_bronze_from_documents(roles.table(spark, SMOKE, "documents")), f"{root}/bronze_netex_quays")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("zone,maintained", [(None, False), ("Europe/Stockholm", False), (None, True)])
def test_views_equal_the_models(spark, tmp_path, zone, maintained):
    root, gold = str(tmp_path / "bronze"), str(tmp_path / "gold")
    bronze(spark, root)
    silver = str(tmp_path / "silver") if maintained else None
    if silver:
        models.refresh_silver_timetable(spark, root, silver)
    name = f"views_{maintained}_{zone is None}".lower()
    models.run_models(spark, root, gold, zone=zone, silver_path=silver, database=name)
    other = spark.newSession()
    want = models.build_models(*models.read_bronze(spark, root), zone=zone)
    for view in models.VIEWS:
        assert not spark.catalog.tableExists(view)                                  # no temporary view of that name is left
        assert rows(other.table(f"{name}.{view}")) == rows(want[view]), view
    for table in models.TABLES:
        assert rows(other.table(f"{name}.{table}")) == rows(want[table]), table
    joined = other.sql(f"SELECT count(*) FROM {name}.fact_movements f JOIN {name}.dim_service_journey j USING (service_journey_id, date_id)")
    assert joined.first()[0] >= other.table(f"{name}.fact_movements").count() > 0


def test_names_follow_loads_and_days(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path)
    d1, d2, d3 = (dt.date(2025, 1, d) for d in (1, 2, 3))
    frame = lambda v, *days: spark.createDataFrame([(v, d) for d in days], "v string, Ingestion_Date date")
    db = Database(spark, "follow", root)
    tables.overwrite_partitions(frame("a", d1, d2), path)
    db.table("t", path, frame("a", d1).schema, "Ingestion_Date")
    db.view("w", "SELECT Ingestion_Date, v FROM follow.t WHERE v <> 'x'")
    other = spark.newSession()
    read = lambda: sorted((r.Ingestion_Date, r.v) for r in other.table("follow.w").collect())
    assert read() == [(d1, "a"), (d2, "a")]
    tables.overwrite_partitions(frame("b", d2, d3), path)
    assert read() == [(d1, "a"), (d2, "a")]                                         # one version until it is pointed on
    db.sync("t")
    assert read() == [(d1, "a"), (d2, "b"), (d3, "b")]
    tables.overwrite_partitions(frame("c", d3), path, gone=[d1])
    db.sync()
    assert read() == [(d2, "b"), (d3, "c")]
    for _ in range(5):                                                              # the version pointed at is gone by now
        tables.overwrite_partitions(frame("e", d1), path)
    from kollektiv.sinks import versions
    versions.vacuum(spark, path, keep=1, seconds=0)
    db.sync()
    assert read() == [(d1, "e"), (d2, "b"), (d3, "c")]
    plan = other.sql("SELECT v FROM follow.w WHERE Ingestion_Date = DATE'2025-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Ingestion_Date" in plan


def test_plain_and_whole_tables(spark, tmp_path):
    plain, whole = str(tmp_path / "plain"), str(tmp_path / "whole")
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    frame = lambda v, d: spark.createDataFrame([(v, d)], "v string, Ingestion_Date date")
    db = Database(spark, "plain_whole", str(tmp_path))
    db.table("empty", str(tmp_path / "none"), frame("a", d1).schema, "Ingestion_Date")
    assert spark.table("plain_whole.empty").count() == 0
    tables.append_bronze(frame("a", d1), plain)
    db.table("p", plain, frame("a", d1).schema, "Ingestion_Date")
    tables.append_bronze(frame("b", d2), plain)
    db.sync("p")
    assert sorted(r.v for r in spark.table("plain_whole.p").collect()) == ["a", "b"]
    tables.publish_table(frame("a", d1), whole)
    db.table("g", whole, frame("a", d1).schema)
    tables.publish_table(frame("b", d1), whole)
    db.table("g", whole, frame("a", d1).schema)
    assert [r.v for r in spark.table("plain_whole.g").collect()] == ["b"]
    tables.publish_table(frame("b", d1).withColumn("n", F.lit(1)), whole)           # another shape
    db.table("g", whole, frame("b", d1).withColumn("n", F.lit(1)).schema)
    assert [tuple(r) for r in spark.table("plain_whole.g").collect()] == [("b", d1, 1)]


def test_another_application_attaches(spark, tmp_path):
    """A new JVM with an empty catalog gets the names back from the folder."""
    root, gold = str(tmp_path / "bronze"), str(tmp_path / "gold")
    bronze(spark, root)
    models.run_models(spark, root, gold, database="elsewhere")
    want = {v: spark.table(f"elsewhere.{v}").count() for v in (*models.VIEWS, *models.TABLES)}
    code = ("import json, sys\nfrom kollektiv.session import build_session\nfrom kollektiv.sinks.catalog import Database\n"
            "s = build_session('local[2]', shuffle_partitions=4)\ns.catalog.dropTempView('x')\n"
            f"names = Database(s, 'elsewhere', {gold!r}).attach()\n"
            f"print('COUNTS', json.dumps({{v: s.table('elsewhere.' + v).count() for v in {list(want)!r}}}))\n")
    env = os.environ | {"PYTHONPATH": REPO}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env, cwd=str(tmp_path), check=False)
    lines = [x for x in out.stdout.splitlines() if x.startswith("COUNTS ")]
    assert lines and json.loads(lines[0][7:]) == want, out.stderr[-2000:]

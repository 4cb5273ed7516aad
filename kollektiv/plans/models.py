"""Entry point C: the nine models over the bronze tables.

Staging and silver models are published as views (SNK-3) — Catalyst inlines
them, so filters and column pruning reach the bronze scans; gold models are
rebuilt tables (SNK-4).  The chain is one logical plan per gold table; the
"compile" step of the reference's model tool is Catalyst itself.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kollektiv.operators import counted_distinct, order_table
from kollektiv.plans import gold, silver, staging
from kollektiv.plans.view_sql import SILVER_TABLE, view_statements
from kollektiv.schemas import BRONZE_LIVE, BRONZE_LIVE_KEY, BRONZE_NETEX, NETEX_RECORDS, PARTITION_COLUMN
from kollektiv.session import stage_table, staging_scope, use_scope
from kollektiv.sinks import versions
from kollektiv.sinks.catalog import Database
from kollektiv.sinks.tables import overwrite_partitions, publish_table, publish_view, read_table

VIEWS = ("stg_live_timetable", "stg_netex_lines", "stg_netex_quays", "silver_timetable", "silver_lines")
TABLES = ("dim_quay", "dim_service_journey", "fact_movements", "dim_line")


def build_models(bronze_live: DataFrame, bronze_lines: DataFrame, bronze_quays: DataFrame,
                 zone: str | None = None, latest_lines_only: bool = False,
                 materialize_silver: bool = False) -> dict[str, DataFrame]:
    """All nine models as DataFrames.

    ``materialize_silver`` writes ``silver_timetable`` once (a staged table
    in the shared checkpoint folder): three gold tables read it, so
    replace-on-key — the heaviest shuffle — runs once instead of three times.
    ``fact_movements`` runs its numbering checkpoint when it is built.
    """
    m: dict[str, DataFrame] = {}
    m["stg_live_timetable"] = staging.stg_live_timetable(bronze_live)
    m["stg_netex_lines"] = staging.stg_netex_lines(bronze_lines)
    m["stg_netex_quays"] = staging.stg_netex_quays(bronze_quays)
    m["silver_timetable"] = silver.silver_timetable(m["stg_live_timetable"], zone)
    if materialize_silver:
        m["silver_timetable"] = stage_table(m["silver_timetable"], "silver_timetable")
    m["silver_lines"] = silver.silver_lines(m["stg_netex_lines"])
    m["dim_quay"] = gold.dim_quay(m["stg_netex_quays"], m["silver_timetable"])
    m["dim_service_journey"] = gold.dim_service_journey(m["silver_timetable"], zone)
    m["dim_line"] = gold.dim_line(m["silver_lines"], latest_only=latest_lines_only)
    m["fact_movements"] = gold.fact_movements(m["silver_timetable"], zone)
    return m


def read_bronze(spark: SparkSession, bronze_root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    root = bronze_root.rstrip("/")
    return (read_table(spark, f"{root}/bronze_live_timetable", BRONZE_LIVE),
            read_table(spark, f"{root}/{NETEX_RECORDS['line'][1]}", BRONZE_NETEX),
            read_table(spark, f"{root}/{NETEX_RECORDS['quay'][1]}", BRONZE_NETEX))


SILVER_TIMETABLE_SCHEMA = None   # set below: bronze live schema without Ingestion_Timestamp


def refresh_silver_timetable(spark: SparkSession, bronze_root: str | None, silver_path: str,
                             days: list | None = None, zone: str | None = None,
                             live_path: str | None = None) -> list:
    """Maintain ``silver_timetable`` as a day-partitioned table, recomputing
    only ``days`` (all days when None).

    Replace-on-key never crosses ingestion days, so a day's silver rows depend
    on that day's bronze partition alone: the bronze read is pruned to the
    given days and the result replaces exactly those silver partitions.  A day
    whose recomputed silver is empty loses its old partition.  Returns the
    days refreshed.  ``live_path`` names the bronze live table directly.
    """
    live = read_table(spark, live_path or f"{bronze_root.rstrip('/')}/bronze_live_timetable", BRONZE_LIVE)
    if days is not None:
        live = live.filter(F.col(PARTITION_COLUMN).isin(list(days)))
    fresh = silver.silver_timetable(staging.stg_live_timetable(live), zone)
    with staging_scope(spark):
        fresh = stage_table(fresh, "silver_days")          # replace-on-key runs once
        written = {r[0] for r in fresh.select(PARTITION_COLUMN).distinct().collect()}      # one row per day
        asked = set(days) if days is not None else versions.days_of(spark, silver_path, PARTITION_COLUMN)
        # days without silver any more end in the same step
        overwrite_partitions(fresh, silver_path, sort_key=list(BRONZE_LIVE_KEY), gone=asked - written)
    return sorted(asked | written) if days is None else list(days)


def refresh_numbered_timetable(spark: SparkSession, silver_path: str, numbered_path: str) -> order_table.Change:
    """Maintain the numbered timetable (WIN-1) beside a maintained silver.

    The manifests of silver say which days differ between the version that the
    numbers were made from and the newest; only those days are read, in both
    versions, and only rows that differ change the order table.  If that older
    version is gone (``versions.vacuum``), or there is none, all is numbered anew.
    """
    notes, whole, old, new = _silver_difference(spark, silver_path, numbered_path)
    if old is None:
        return order_table.build(whole, numbered_path, gold.FACT_ORDER, notes)
    return order_table.change(spark, numbered_path, old.exceptAll(new), new.exceptAll(old), gold.FACT_ORDER, notes)


def _silver_difference(spark: SparkSession, silver_path: str, path: str):
    """(notes, all of silver, old rows, new rows) of the days in which the newest
    silver differs from the version that ``path`` was made from; no old and new
    rows where that version is gone or there was none."""
    newest, held = versions.current(spark, silver_path), versions.current(spark, path)
    notes, before = {"source_version": newest["version"]}, None
    whole = versions.read(spark, silver_path, SILVER_TIMETABLE_SCHEMA, newest["version"])
    if held is not None:
        try:
            before = versions.current(spark, silver_path, held["notes"]["source_version"])
        except ValueError:
            before = None
    if before is None:
        return notes, whole, None, None
    added, moved, ended = versions.changed_days(before, newest)
    return (notes, whole,
            versions.read(spark, silver_path, SILVER_TIMETABLE_SCHEMA, before["version"], only=[*moved, *ended]),
            versions.read(spark, silver_path, SILVER_TIMETABLE_SCHEMA, newest["version"], only=[*moved, *added]))


def counted_paths(counted_root: str) -> dict[str, str]:
    return {name: f"{counted_root.rstrip('/')}/{name}" for name in ("service_journeys", "quay_stops")}


def refresh_counted_dimensions(spark: SparkSession, silver_path: str, counted_root: str,
                               zone: str | None = None) -> dict[str, counted_distinct.Change]:
    """Maintain what ``dim_service_journey`` and ``dim_quay`` take from the
    timetable, distinct rows with their supports, by the days that silver replaced."""
    done = {}
    for name, path in counted_paths(counted_root).items():
        rows = (lambda df: gold.journeys(df, zone)) if name == "service_journeys" else gold.quay_stops
        notes, whole, old, new = _silver_difference(spark, silver_path, path)
        done[name] = (counted_distinct.build(rows(whole), path, notes) if old is None
                      else counted_distinct.change(spark, path, rows(old), rows(new), notes))
    return done


def _current_for(spark: SparkSession, silver_path: str | None, path: str) -> str:
    """``path``, if it was made from the newest silver."""
    if not silver_path:
        raise ValueError("maintained numbers and supports need the maintained silver they were made from")
    held, newest = versions.current(spark, path), versions.current(spark, silver_path)
    if held is None or held["notes"]["source_version"] != newest["version"]:
        raise ValueError(f"{path} does not hold version {newest['version']} of {silver_path}: refresh it first")
    return path


def read_silver_timetable(spark: SparkSession, silver_path: str) -> DataFrame:
    return read_table(spark, silver_path, SILVER_TIMETABLE_SCHEMA)


def run_models(spark: SparkSession, bronze_root: str, gold_root: str, zone: str | None = None,
               threads: int = 4, timings: dict | None = None, latest_lines_only: bool = False,
               silver_path: str | None = None, database: str | None = None,
               numbered_path: str | None = None, counted_root: str | None = None) -> dict[str, str]:
    """Publish the views and rebuild the gold tables (``threads`` at a time);
    returns ``{gold model: path}``.  With ``database`` the views and tables are
    names of that database, which outlive the run (``publish_names``); without,
    the views are temporary ones of this session.  ``timings`` receives seconds per model;
    ``latest_lines_only`` keeps one ``dim_line`` row per line (D9).
    ``silver_path``: read a silver timetable maintained by
    ``refresh_silver_timetable`` instead of de-duplicating the bronze history.
    ``numbered_path``: take the numbers of the fact from the table that
    ``refresh_numbered_timetable`` maintains, and sort nothing; it has to hold the
    newest version of ``silver_path``.  ``counted_root``: likewise, take the distinct
    rows of ``dim_quay`` and ``dim_service_journey`` from
    ``refresh_counted_dimensions``.

    ``silver_timetable`` is staged once, range-sorted in fact order, and serves
    all three gold tables that read it (for ``fact_movements`` it is also step
    1 of the numbering).  Each gold table is written in its own thread;
    ``dim_line``, which does not read the timetable, runs during the staging.
    """
    with staging_scope(spark) as scope:
        built = _run(spark, bronze_root, gold_root, zone, threads, timings, scope, latest_lines_only, silver_path,
                     temporary_views=database is None, numbered_path=numbered_path, counted_root=counted_root)
    if database is not None:
        publish_names(spark, database, bronze_root, gold_root, built, zone, silver_path)
    return built


def publish_names(spark: SparkSession, database: str, bronze_root: str, gold_root: str, gold_paths: dict[str, str],
                  zone: str | None = None, silver_path: str | None = None) -> Database:
    """SNK-3: external tables over bronze, gold (and a maintained silver), and
    the five staging and silver models as views, in ``database``."""
    db, root = Database(spark, database, gold_root), bronze_root.rstrip("/")
    db.table("bronze_live_timetable", f"{root}/bronze_live_timetable", BRONZE_LIVE, PARTITION_COLUMN)
    for record in ("line", "quay"):
        table = NETEX_RECORDS[record][1]
        db.table(table, f"{root}/{table}", BRONZE_NETEX, PARTITION_COLUMN)
    if silver_path:
        db.table(SILVER_TABLE, silver_path, SILVER_TIMETABLE_SCHEMA, PARTITION_COLUMN)
    for name, sql in view_statements(database, zone, bool(silver_path)).items():
        db.view(name, sql)
    for name, path in gold_paths.items():
        db.table(name, path, read_table(spark, path).schema)
    return db


def _run(spark, bronze_root, gold_root, zone, threads, timings, scope, latest_lines_only,
         silver_path, temporary_views=True, numbered_path=None, counted_root=None) -> dict[str, str]:
    live, lines, quays = read_bronze(spark, bronze_root)
    views = {
        "stg_live_timetable": staging.stg_live_timetable(live),
        "stg_netex_lines": staging.stg_netex_lines(lines),
        "stg_netex_quays": staging.stg_netex_quays(quays),
    }
    views["silver_lines"] = silver.silver_lines(views["stg_netex_lines"])

    def publish(name: str, build) -> tuple[str, str, float]:
        path = f"{gold_root.rstrip('/')}/{name}"
        t = time.perf_counter()
        with use_scope(scope):          # staged tables written here belong to this run
            publish_table(build(), path)
        return name, path, time.perf_counter() - t

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        # dim_line does not read the timetable: it runs while silver is staged
        futures = [pool.submit(publish, "dim_line",
                               lambda: gold.dim_line(views["silver_lines"], latest_only=latest_lines_only))]
        t0 = time.perf_counter()
        # one staged write serves all three readers of silver: it is range-sorted
        # in fact order (numbering step 1); without the two tag columns it *is* silver
        silver_src = (read_silver_timetable(spark, silver_path) if silver_path
                      else silver.silver_timetable(views["stg_live_timetable"], zone))
        if numbered_path:
            silver_staged, build_fact = silver_src, lambda: gold.fact_movements_from_numbered(
                order_table.read(spark, _current_for(spark, silver_path, numbered_path)), zone)
        else:
            ranked = gold.rank_timetable(silver_src)
            silver_staged = ranked.drop(gold.M_COL, gold.P_COL)
            build_fact = lambda: gold.fact_movements_from_ranked(ranked, zone)
        counted = {n: counted_distinct.read(spark, _current_for(spark, silver_path, path))
                   for n, path in counted_paths(counted_root).items()} if counted_root else None
        # what is published outlives this run, so it reads silver, not the staged copy
        views["silver_timetable"] = silver_src
        staged = time.perf_counter() - t0
        for name in VIEWS if temporary_views else ():
            t = time.perf_counter()
            publish_view(views[name], name)
            if timings is not None:
                timings[name] = time.perf_counter() - t + (staged if name == "silver_timetable" else 0.0)
        builders = {
            "dim_quay": lambda: gold.dim_quay(views["stg_netex_quays"], counted["quay_stops"] if counted else silver_staged),
            "dim_service_journey": lambda: (counted["service_journeys"] if counted
                                            else gold.dim_service_journey(silver_staged, zone)),
            "fact_movements": build_fact,
        }
        futures += [pool.submit(publish, n, b) for n, b in builders.items()]
        done = [f.result() for f in futures]
    if timings is not None:
        timings.update({n: secs for n, _, secs in done})
    return {n: p for n, p, _ in done}


def register_views(spark: SparkSession, bronze_root: str, zone: str | None = None) -> list[str]:
    """All nine models as temporary views over the bronze tables, nothing
    written: ``spark.sql("SELECT ... FROM dim_quay")`` plans straight down to
    the bronze scans.  (``fact_movements`` stages its numbering when built.)"""
    models = build_models(*read_bronze(spark, bronze_root), zone=zone)
    for name, df in models.items():
        publish_view(df, name)
    return list(models)


SILVER_TIMETABLE_SCHEMA = T.StructType([f for f in BRONZE_LIVE.fields if f.name != "Ingestion_Timestamp"])

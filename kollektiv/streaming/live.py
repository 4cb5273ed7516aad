"""STR-1: the minute-by-minute SIRI feed as a Structured Streaming job.

Snapshots land as XML files under ``{landing}/snapshot=<yyyy-MM-ddTHHmmss>/``
(one snapshot may be split over several files).  A running stream waits until a
snapshot has landed whole (``streaming.parts``: a state store of the snapshots that
are landing, each with a time-out), or for the writer's ``marker``; a one-shot run
takes what has landed.  Each micro-batch:

1. reads, whole, every snapshot folder that it is given and extracts the calls (one
   ``mapInPandas``, or ``from_xml`` with ``native``); a snapshot's run clock
   comes from its folder name;
2. gates every snapshot on its own (DQ-1; a malformed file fails its
   snapshot); a failing snapshot is skipped and reported, the stream goes on
   (D13);
3. keeps, per ingestion day, the newest passing snapshot — and only when it is
   newer than what the table already holds for that day, so late or replayed
   files never roll a day back;
4. overwrites exactly those day partitions (SNK-2), and — with
   ``silver_path`` — recomputes silver for exactly those days, so the daily
   model run can read a current silver without de-duplicating the history.

A replayed batch rewrites the same partitions with the same rows: the sink is
idempotent.  Every choice is a DataFrame operation; verdicts are computed once
per batch and go to a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kollektiv.functions.scalars import parse_timestamp, truncate_millis
from kollektiv.operators.quality import NULL_RATE_CEILING_PCT
from kollektiv.schemas import BRONZE_LIVE, BRONZE_LIVE_KEY, LIVE_COLUMNS, PARTITION_COLUMN, VERSION_COLUMN
from kollektiv.session import stage_table, staging_scope
from kollektiv.sinks import versions
from kollektiv.sinks.tables import overwrite_partitions, read_table
from kollektiv.sources import siri
from kollektiv.streaming.parts import FOLDER_PATTERN, SETTLE_SECONDS, STATE_STORE, settled_snapshots

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])
SNAPSHOT_PATTERN = r"snapshot=(\d{4}-\d{2}-\d{2}T\d{6})"


def snapshot_clock(path: F.Column) -> dict[str, F.Column]:
    label = F.regexp_extract(path, SNAPSHOT_PATTERN, 1)
    ts = F.to_timestamp_ntz(F.nullif(label, F.lit("")), F.lit("yyyy-MM-dd'T'HHmmss"))
    return {"snapshot": label, "Ingestion_Timestamp": truncate_millis(ts), "Ingestion_Date": F.to_date(ts)}


def select_snapshots(raw: DataFrame, existing: DataFrame | None,
                     ceiling_pct: float = NULL_RATE_CEILING_PCT, with_chosen: bool = False,
                     stage_verdicts: bool = False):
    """Raw extraction of one batch -> (rows to write, per-snapshot verdicts
    [, the chosen snapshots with their days])."""
    tagged = raw.withColumns(snapshot_clock(F.col("path")))
    calls = siri.to_bronze(siri.calls(tagged), keep=("snapshot",))
    is_call = F.col("error").isNull()
    arrival = truncate_millis(parse_timestamp("ActualArrivalTime"))
    verdicts = (tagged.groupBy("snapshot", "Ingestion_Timestamp", "Ingestion_Date").agg(
                    F.count_if(~is_call).alias("rejected_files"), F.count_if(is_call).alias("rows"),
                    F.count_if(is_call & arrival.isNull()).alias("nulls"))
                .withColumn("null_pct", F.when(F.col("rows") > 0, F.col("nulls") * 100.0 / F.col("rows"))
                            .otherwise(F.lit(0.0)))
                .withColumn("passed", (F.col("rejected_files") == 0) & (F.col("rows") > 0)
                            & (F.col("null_pct") <= F.lit(ceiling_pct))
                            & F.col("Ingestion_Timestamp").isNotNull()))
    if stage_verdicts:
        verdicts = stage_table(verdicts, "verdicts")        # a row per snapshot; read several times
    newest = (verdicts.filter("passed")
              .withColumn("__rank", F.row_number().over(
                  Window.partitionBy("Ingestion_Date").orderBy(F.col("Ingestion_Timestamp").desc(),
                                                               F.col("snapshot").desc())))
              .filter("__rank = 1").drop("__rank"))
    if existing is not None:
        held = existing.groupBy(PARTITION_COLUMN).agg(F.max(VERSION_COLUMN).alias("__held"))
        newest = (newest.join(held, PARTITION_COLUMN, "left")
                  .filter(F.col("__held").isNull() | (F.col("Ingestion_Timestamp") >= F.col("__held")))
                  .drop("__held"))
    if stage_verdicts:
        newest = stage_table(newest, "chosen")
    rows = calls.join(newest.select("snapshot"), "snapshot", "left_semi").select(*LIVE_COLUMNS)
    if with_chosen:
        return rows, verdicts, newest.select("snapshot", PARTITION_COLUMN)
    return rows, verdicts


def snapshot_folders(batch: DataFrame) -> list[str]:
    """The snapshot folders a micro-batch touches (one small row per snapshot)."""
    if "folder" in batch.columns:                        # settled snapshots
        return sorted({r["folder"] for r in batch.select("folder").collect()})
    folder = F.regexp_extract(F.col("path"), FOLDER_PATTERN, 1)
    return [r[0] for r in batch.select(folder.alias("f")).filter("f <> ''").distinct().collect()]


def process_batch(batch: DataFrame, bronze_path: str, report: list | None = None,
                  ceiling_pct: float = NULL_RATE_CEILING_PCT, native: bool = False,
                  silver_path: str | None = None, verdict_path: str | None = None) -> None:
    """``foreachBatch`` body: stage, gate, choose, overwrite.

    ``batch`` names snapshots: settled ones (``folder``), or by files of them
    (``path``).  Every snapshot it names is read whole from its folder: it is
    gated and written as one unit, and a repeat is idempotent.  Settled snapshots
    and markers (``snapshot_stream(marker=...)``) name a snapshot once, when it is
    complete.
    """
    spark = batch.sparkSession
    folders = snapshot_folders(batch)
    if not folders:
        return
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xml")
             .option("recursiveFileLookup", "true").load(folders).select("path", "content"))
    with staging_scope(spark):
        written = _process(spark, files, bronze_path, report, ceiling_pct, native, verdict_path)
    if silver_path and written:
        # keep silver current: only the days this batch replaced are recomputed
        from kollektiv.plans.models import refresh_silver_timetable
        refresh_silver_timetable(spark, None, silver_path, written, live_path=bronze_path)


def _process(spark, files, bronze_path, report, ceiling_pct, native, verdict_path=None) -> list:
    raw = stage_table(siri.extract_native(files) if native else siri.extract(files), "siri_batch")
    days = [r[0] for r in raw.select(snapshot_clock(F.col("path"))["Ingestion_Date"]).distinct().collect()]
    existing = _existing(spark, bronze_path, days)
    rows, verdicts, chosen = select_snapshots(raw, existing, ceiling_pct, with_chosen=True, stage_verdicts=True)
    if verdict_path:
        verdicts.withColumn("processed_at", F.current_timestamp()).write.mode("append").parquet(verdict_path)
    if report is not None:                       # tests and one-shot runs only
        report.extend(r.asDict() for r in verdicts.collect())
    days = [r[0] for r in chosen.select(PARTITION_COLUMN).distinct().collect()]   # one row per day
    if days:
        overwrite_partitions(rows, bronze_path, sort_key=list(BRONZE_LIVE_KEY))
    return days


def _existing(spark: SparkSession, bronze_path: str, days: list) -> DataFrame | None:
    """What the table holds for the batch's days only (partition-pruned scan)."""
    if not versions.days_of(spark, bronze_path, PARTITION_COLUMN):
        return None
    held = read_table(spark, bronze_path, BRONZE_LIVE).select(PARTITION_COLUMN, VERSION_COLUMN)
    return held.filter(F.col(PARTITION_COLUMN).isin([d for d in days if d is not None]))


def snapshot_stream(spark: SparkSession, landing: str, max_files_per_trigger: int = 1000,
                    marker: str | None = None) -> DataFrame:
    """The landing folder as a stream of ``(path, length)`` rows: of its XML
    files, or, with ``marker``, of the files of that name which a writer puts
    into a snapshot folder last.  A trigger then takes whole snapshots, and one
    whose files are still landing waits.  ``landing`` may be a glob of day
    folders, so that days done with need not be listed."""
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", marker or "*.xml")
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(landing)
            .select("path", "length"))                     # contents are read by the batch, not listed twice


def run_live_stream(spark: SparkSession, landing: str, bronze_path: str, checkpoint_location: str,
                    available_now: bool = True, processing_time: str = "1 minute",
                    report: list | None = None, max_files_per_trigger: int = 1000, native: bool = False,
                    silver_path: str | None = None, verdict_path: str | None = None, marker: str | None = None,
                    settle_seconds: float | None = None):
    """Start STR-1.  ``available_now`` processes what has landed and stops
    (backfills, tests); otherwise a trigger every ``processing_time``.
    ``verdict_path``: table that gets one row per snapshot and batch.

    ``settle_seconds``: a snapshot is taken when no file of it has come for so
    long.  Default: ``SETTLE_SECONDS`` for a running stream; 0 (what has landed
    is taken as it is) for a one-shot run, which ends before any time-out, and
    with a ``marker``, which says more than a time-out does.  Files that one
    trigger does not reach wait in the landing folder, so a backlog that takes
    several triggers needs ``settle_seconds`` above the time between two of them."""
    if settle_seconds is None:
        settle_seconds = 0 if available_now or marker else SETTLE_SECONDS
    elif settle_seconds > 0 and (available_now or marker):
        raise ValueError("settle_seconds is for a running stream without a marker")
    names = snapshot_stream(spark, landing, max_files_per_trigger, marker)
    if settle_seconds > 0:
        names = settled_snapshots(names, settle_seconds)
    writer = (names.writeStream
              .foreachBatch(lambda df, _epoch: process_batch(df, bronze_path, report, native=native,
                                                             silver_path=silver_path, verdict_path=verdict_path))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    if settle_seconds <= 0:
        return writer.start()
    key, store = STATE_STORE
    before = spark.conf.get(key)
    spark.conf.set(key, store)                           # the query keeps the settings it starts with
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)

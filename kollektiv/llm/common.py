"""Shared helpers: reading tables, staging, Arrow batches in bounded slices."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv import session
from kollektiv.operators.ids import dense_row_number
from kollektiv.session import ensure_checkpoint_dir, scratch_path, ship_package

__all__ = ["WORD", "arrow_map", "ascii_lower", "byte_slices", "keyed", "prepare", "scratch_path", "shards",
           "stage_bucketed", "stage_table", "table"]

#: A word: a run of anything but space, tab, line feed, VT, form feed, CR.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings the Python steps rely on: Arrow batches bounded by
    rows and bytes, the package importable on executors, a checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.  The
    shuffle files of the write go when it is done, so an operator of several
    staged steps never holds more than one step's on disk."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return session.stage_table(df, name)
    finally:
        conf.set(_CLEANUP, before)


def stage_bucketed(df: DataFrame, name: str, column: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Like ``stage_table``, bucketed by ``column``: joins on it leave these
    rows where they are.  ``dealt``: the inputs of ``df`` are in ``buckets`` parts
    by it already, and a join on it and other columns leaves them there."""
    spark, conf = df.sparkSession, df.sparkSession.conf
    path, before, all_keys = scratch_path(spark, name), conf.get(_CLEANUP), conf.get(_ALL_KEYS)
    table_name = f"staged_{uuid.uuid4().hex[:12]}"
    conf.set(_CLEANUP, "true")
    if dealt:
        conf.set(_ALL_KEYS, "false")
    try:
        ((df if dealt else df.repartition(buckets, column)).write.format("parquet").bucketBy(buckets, column).sortBy(column)
         .option("path", path).saveAsTable(table_name))
    finally:
        conf.set(_CLEANUP, before)
        conf.set(_ALL_KEYS, all_keys)
    session.note_staged(path)
    return spark.table(table_name)


def shards(spark: SparkSession, n_bytes: int, each: int = 16 << 20) -> int:
    """Groups of about ``each`` bytes for ``n_bytes`` of data, at least one per
    shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // each))


#: Ids and word positions that fit one 63-bit number together.
KEY_BITS, POSITION_BITS = 36, 27


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(key, text) with a unique key below 2**36 that orders rows by id (nulls
    last), then by text; and (key, doc_id, copies) to get back to the rows.

    Ids that are unique and small enough, as they mostly are, serve as keys.
    Otherwise the distinct (id, text) rows are numbered: rows alike in both are
    one document, whose result holds for each of them.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.max(F.col("doc_id").isNull()).alias("none")).first()
    if not ids.n or (ids.n == 1 and not ids.none and ids.low >= 0 and ids.high < 1 << KEY_BITS):
        return (rows.select(F.col("doc_id").alias("key"), "text"),
                rows.select(F.col("doc_id").alias("key"), "doc_id", F.lit(1).alias("copies")))
    alike = rows.groupBy("doc_id", F.sha2("text", 256).alias("digest")).agg(
        F.first("text").alias("text"), F.count(F.lit(1)).cast("int").alias("copies"))
    numbered = stage_table(dense_row_number(alike, [F.col("doc_id").asc_nulls_last(), F.col("digest").asc()], "key"), "keyed")
    return numbered.select("key", "text"), numbered.select("key", "doc_id", "copies")


def per_row(result: DataFrame, rows: DataFrame) -> DataFrame:
    """``result`` by key, back to one row per input row with its doc_id."""
    return (rows.join(result, "key").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .drop("key", "copies"))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, _UPPER, _LOWER)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch; empty batches are skipped."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from fn(b)
    return df.mapInArrow(run, schema)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` whose ``column`` holds at most ``limit``
    bytes each (one row at least), so working memory follows the slice and not
    the batch.  Every row is in exactly one slice."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)

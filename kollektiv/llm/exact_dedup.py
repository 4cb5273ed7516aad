"""Exact dedup with a persistent digest index.

The index is a Parquet table of (digest, keep_id), bucketed and sorted by the
digest.  New data is reduced to one row per digest, anti-joined with the index
by a sort-merge join (the index side needs no shuffle) and what is new is
appended.  The index survives the session: its files, and the bucket count that
an empty file ``_buckets_N`` beside them names, are all that a later run needs.
A digest that an earlier run added keeps that run's row; group sizes are of the
rows at hand.

Defined cases: null text is empty; equal means identical after lower-casing
A-Z only; null ids are lower than any other; of equal (id, text) rows one is
kept; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv.llm.common import ascii_lower, scratch_path, stage_table


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per (id, digest): doc_id, digest (32 bytes), copies."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return (docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
            .groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")))


class DigestIndex:
    """Digests seen so far and the row that stays for each."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        """Opens the index at ``path``, with the bucket count it was made with;
        ``buckets`` is for a new one."""
        self.spark, self.path = spark, path
        self.buckets = self._made_with(buckets)
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        # not by a write, which would clear a folder that the catalog does not know
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'")

    def _made_with(self, buckets: int) -> int:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        for n in names:
            if n.startswith("_buckets_"):
                return int(n.removeprefix("_buckets_"))
        if any(n.endswith(".parquet") for n in names):
            raise ValueError(f"{self.path} holds files but no bucket count")
        fs.create(hadoop.Path(folder, f"_buckets_{buckets}")).close()
        return buckets

    def _append(self, rows: DataFrame) -> None:
        # one sorted file per bucket and append
        (rows.repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, batch: DataFrame) -> None:
        """Add the digests of ``batch`` (doc_id, digest) that the index lacks;
        of a digest's rows in the batch the largest id stays."""
        fresh = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        self._append(fresh.join(self.entries().select("digest").hint("merge"), "digest", "left_anti"))


def exact_dedup(docs: DataFrame, index_path: str | None = None, batches: int = 2,
                buckets: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    The rows go into the index in ``batches`` of descending id ranges, so the
    first row that the index meets of a group is the one with the largest id.
    """
    spark = docs.sparkSession
    rows = stage_table(digests(docs), "digests")
    cuts = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("c")).first().c or []
    index = DigestIndex(spark, index_path or scratch_path(spark, "digest-index"),
                        buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = [None, *sorted(set(cuts)), None]
    for low, high in reversed(list(zip(edges, edges[1:], strict=False))):
        part = rows
        if low is not None:
            part = part.filter(F.col("doc_id") >= low)
        if high is not None:            # the lowest range also takes null ids
            part = part.filter((F.col("doc_id") < high) | (F.col("doc_id").isNull() if low is None else F.lit(False)))
        index.add(part)
    groups = (rows.groupBy("digest").agg(F.sum("copies").alias("group_size"))
              .join(index.entries(), "digest"))
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return (rows.join(groups, "digest").select("doc_id", "keep_id", "group_size", "digest", copy)
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))

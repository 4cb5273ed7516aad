"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the pipeline relies on.  They are runtime SQL confs;
# ``apply_conf`` sets them on a session someone else built.
PIPELINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # D3: days are derived in UTC unless a caller asks for another zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # XML documents travel to Python in Arrow batches; bound them by bytes
    # as well as by rows so a batch of large documents cannot blow the worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def apply_conf(spark: SparkSession) -> None:
    """Set ``PIPELINE_CONF`` on a session built elsewhere."""
    for k, v in PIPELINE_CONF.items():
        spark.conf.set(k, v)


def build_session(master: str | None = None, app: str = "kollektiv",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the pipeline's settings."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in PIPELINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins.  Only on a local master may it
    be unset; a fallback folder is then used.  On a cluster a machine-local
    folder would lose data, so an unset folder raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    target = configured or fallback
    if not target:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: staged tables need a folder that all executors share")
        target = os.path.join("/tmp", "kollektiv-checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir, for staged tables.

    Staged tables live in the shared folder, never on a machine-local disk, so
    every executor and a restarted driver can read them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kollektiv-{name}-{uuid.uuid4().hex[:12]}"


class StagingScope:
    """Staged tables written for one job; dropped when the job is done."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self._lock = threading.Lock()

    def add(self, path: str) -> None:
        with self._lock:
            self.paths.append(path)

    def drop(self, spark: SparkSession) -> int:
        jvm = spark.sparkContext._jvm  # noqa: SLF001
        conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
        removed = 0
        with self._lock:
            paths, self.paths = self.paths, []
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            fs = path.getFileSystem(conf)
            if fs.exists(path):
                fs.delete(path, True)
                removed += 1
        return removed


_local = threading.local()


@contextmanager
def use_scope(scope: StagingScope | None):
    """Make ``scope`` the current staging scope of this thread."""
    prev = getattr(_local, "scope", None)
    _local.scope = scope
    try:
        yield scope
    finally:
        _local.scope = prev


@contextmanager
def staging_scope(spark: SparkSession):
    """Tables staged inside the block (by this thread, or by threads that
    ``use_scope`` it) are deleted when the block ends — once every frame
    reading them has been written out."""
    scope = StagingScope()
    try:
        with use_scope(scope):
            yield scope
    finally:
        scope.drop(spark)


def note_staged(path: str) -> None:
    """Leave ``path`` to this thread's staging scope, if there is one."""
    scope = getattr(_local, "scope", None)
    if scope is not None:
        scope.add(path)


def stage_table(df, name: str, partition_by: tuple[str, ...] = (), rebalance: bool = True):
    """Cut lineage: write ``df`` once as a Parquet table in the shared
    checkpoint folder and return a frame reading it back.

    Used where several jobs must see the same rows (numbering, per-type splits
    of parsed records, gate-then-write).  Parquet is columnar and compressed,
    and reads back vectorised; the files survive the loss of any executor.
    ``partition_by`` lays the table out in folders (with a ``rebalance`` so a
    dominant value is split, not piled into one task), so readers that filter
    on those columns read only their folders.  Without ``rebalance`` every task
    writes its own rows, a file for each value it has.
    """
    path = scratch_path(df.sparkSession, name)
    writer = (df.hint("rebalance", *partition_by) if partition_by and rebalance else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    note_staged(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df, target_bytes: int | None = None, floor: int | None = None) -> int:
    """Partition count for an explicit-count shuffle of ``df``: the plan's
    estimated size over the advisory partition size, never below the session's
    shuffle partitions (AQE cannot resize an explicit-count repartition, so
    the count has to grow with the data)."""
    spark = df.sparkSession
    if target_bytes is None:
        target_bytes = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    if floor is None:
        floor = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        est = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # noqa: SLF001
    except Exception:  # noqa: BLE001 — no estimate: fall back to the floor
        est = 0
    default = _bytes(spark.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    if est >= min(default, 1 << 60):        # "unknown" (e.g. RDD-backed): no basis to scale up
        est = 0
    return int(max(floor, -(-est // max(1, target_bytes))))


def _bytes(text: str) -> int:
    t = str(text).strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if t and t[-1] in mult:
        return int(float(t[:-1]) * mult[t[-1]])
    return int(t)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``kollektiv`` importable on the executors' Python workers.

    Steps that run Python on the workers (``mapInPandas``) unpickle functions
    of this package there.  Once per application the package is zipped into
    the shared checkpoint folder and registered with ``addPyFile``; a cluster
    that already installs the package loses nothing.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        import io
        import zipfile

        root = os.path.dirname(os.path.abspath(__file__))
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        target = f"{scratch_path(spark, 'pyfiles')}/kollektiv.zip"
        _write_bytes(target, buf.getvalue())
        sc.addPyFile(target)
        _SHIPPED.add(app)


def _write_bytes(uri: str, data: bytes) -> None:
    from pyarrow import fs as pafs
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        filesystem = pafs.LocalFileSystem()
    elif "://" in uri:
        filesystem, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    else:
        filesystem, path = pafs.LocalFileSystem(), uri
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(path) as f:
        f.write(data)

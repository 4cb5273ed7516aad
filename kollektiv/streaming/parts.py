"""Snapshots as units: a state store that waits until a snapshot has landed whole.

A snapshot may be split over many files that land over some time, and nothing in
the feed says which one is the last.  ``settled_snapshots`` turns the stream of
landed files (names only, no contents) into one row per snapshot, given out when
no further file of it has come for ``settle_seconds``.

* State is keyed by snapshot folder and holds how many files and bytes have come
  and when the wait ends; each further file moves that on.  It lives in the
  query's checkpoint, so a snapshot that is half landed when the job stops or an
  executor is lost is still half landed afterwards, not forgotten.
* What has been given out leaves the state, so it holds only snapshots that are
  landing now.  A file that comes later than that opens its snapshot anew, which is
  then given out again, and read whole again.
* Files outside a snapshot folder are passed over.
* Waits are over processing time, so the last snapshot needs no successor to be
  given out; the query runs a batch every trigger, files or not.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: Seconds without a further file after which a snapshot counts as landed.
SETTLE_SECONDS = 30.0
FOLDER_PATTERN = r"^(.*/snapshot=\d{4}-\d{2}-\d{2}T\d{6})/"
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
SETTLED = "folder string, files long, bytes long"


class Landing(StatefulProcessor):
    """One snapshot folder: files so far, and a timer that each of them moves on."""

    def __init__(self, settle_ms: int):
        self.settle_ms = settle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.landed = handle.getValueState("landed", "files long, bytes long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        files, size, due = self.landed.get() if self.landed.exists() else (0, 0, None)
        for part in rows:
            files, size = files + len(part), size + int(part["length"].sum())
        if due is not None:
            self.handle.deleteTimer(due)
        due = timerValues.getCurrentProcessingTimeInMs() + self.settle_ms
        self.handle.registerTimer(due)
        self.landed.update((files, size, due))
        yield pd.DataFrame({"folder": pd.Series([], dtype=str), "files": pd.Series([], dtype="int64"),
                            "bytes": pd.Series([], dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        files, size, _ = self.landed.get()
        self.landed.clear()
        yield pd.DataFrame({"folder": [key[0]], "files": [files], "bytes": [size]})

    def close(self) -> None:
        pass


def settled_snapshots(files: DataFrame, settle_seconds: float = SETTLE_SECONDS) -> DataFrame:
    """Stream of landed files (``path, length``) -> stream of snapshots that have
    landed whole (``folder, files, bytes``).  The session needs the RocksDB state
    store while the query starts (``STATE_STORE``)."""
    if settle_seconds <= 0:
        raise ValueError("settle_seconds must be above 0")
    folder = F.regexp_extract("path", FOLDER_PATTERN, 1)
    return (files.select(folder.alias("folder"), F.col("length")).filter("folder <> ''")
            .groupBy("folder")
            .transformWithStateInPandas(Landing(int(settle_seconds * 1000)), SETTLED, "Append", "ProcessingTime"))

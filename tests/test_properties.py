"""Property-based checks of the operators against brute force (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from kollektiv.operators import dedupe, ids

KEYS = st.sampled_from(["hot", "a", "b", "c", None])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 5), st.sampled_from(["9", "10", "1", None]), st.integers(0, 3)),
                min_size=0, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_dense_ids_equal_row_number(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, t int, v string, x int")
    order = [F.col(c).asc_nulls_last() for c in ("k", "t", "v", "x")]
    got = sorted((tuple(r) for r in ids.dense_row_number(df, order, "n", num_partitions=parts).collect()), key=repr)
    want = sorted((tuple(r) for r in df.withColumn("n", F.row_number().over(Window.orderBy(*order))).collect()),
                  key=repr)
    assert got == want


@SETTINGS
@given(rows=ROWS)
def test_latest_per_key_is_max_version_per_key(spark, rows):
    day = dt.date(2025, 1, 1)
    data = [(k, day, dt.datetime(2025, 1, 1, 0, 0, t), v, x) for k, t, v, x in rows]
    df = spark.createDataFrame(data, "key string, Ingestion_Date date, Ingestion_Timestamp timestamp_ntz, "
                                     "v string, x int")
    out = dedupe.latest_per_key(df, ["key"])
    got = {r["key"]: r for r in out.collect()}
    assert len(got) == out.count() == len({r[0] for r in rows})
    for k, r in got.items():
        assert r["Ingestion_Timestamp"] == max(d[2] for d in data if d[0] == k)


def test_replace_on_key_plans_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("key"),
                                 F.lit(dt.date(2025, 1, 1)).alias("Ingestion_Date"),
                                 F.col("id").cast("timestamp").cast("timestamp_ntz").alias("Ingestion_Timestamp"))
    plan = _plan(dedupe.latest_per_key(df, ["key"]).filter("key <> '3'"))
    assert plan.count("Exchange hashpartitioning") == 1


@SETTINGS
@given(rows=ROWS)
def test_latest_version_matches_python(spark, rows):
    data = [(k, v, x) for k, _, v, x in rows]
    df = spark.createDataFrame(data, "id string, version string, x int")
    got = {r["id"]: r["version"] for r in dedupe.latest_version(df).collect()}
    for k in {d[0] for d in data}:
        versions = [d[1] for d in data if d[0] == k]
        non_null = [v for v in versions if v is not None]
        assert got[k] == (max(non_null) if non_null else None)

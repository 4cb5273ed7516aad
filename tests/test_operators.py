"""Dedupe (AGG-3/4/6), dense ids (WIN-1/2), quality (AGG-5/7, DQ-1..4), frames (SET-1, PRJ-3/4)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kollektiv.operators import dedupe, frames, ids, quality
from kollektiv.schemas import netex_record_schema


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_latest_version_string_order_and_nulls(spark):
    df = spark.createDataFrame([("a", "9", 1), ("a", "10", 2), ("a", None, 3), ("b", None, 4),
                                (None, "1", 5), (None, "2", 6)], "id string, version string, x int")
    got = {r["id"]: (r["version"], r["x"]) for r in dedupe.latest_version(df).collect()}
    assert got == {"a": ("9", 1), "b": (None, 4), None: ("2", 6)}


def test_latest_per_key_never_merges_days(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    t = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([
        ("k", d1, t, "old"), ("k", d1, t + dt.timedelta(seconds=1), "new"), ("k", d2, t, "day2")],
        "key string, Ingestion_Date date, Ingestion_Timestamp timestamp_ntz, v string")
    got = sorted((r["Ingestion_Date"], r["v"]) for r in dedupe.latest_per_key(df, ["key"]).collect())
    assert got == [(d1, "new"), (d2, "day2")]


def test_latest_per_key_has_map_side_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("key"),
                                  F.lit(dt.date(2025, 1, 1)).alias("Ingestion_Date"),
                                  F.col("id").cast("timestamp").cast("timestamp_ntz").alias("Ingestion_Timestamp"))
    out = dedupe.latest_per_key(df, ["key"])
    p = plan(out)
    assert "WindowGroupLimit" in p       # pre-filter before the shuffle: hot keys shrink map-side
    assert out.count() == 3


def test_drop_full_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "x int, y string")
    assert dedupe.drop_full_duplicates(df).count() == 2


def test_dense_row_number_matches_row_number_under_skew(spark):
    # a third of all rows share one leading key
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        (F.col("id") % 97).cast("string")).alias("k"), (F.col("id") * 7 % 1000).alias("t"), "id")
    order = [F.col("k").asc_nulls_last(), F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]
    got = ids.dense_row_number(df, order, name="n", num_partitions=7)
    want = df.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert "SinglePartition" not in plan(got).split("BroadcastExchange")[0]


def test_positional_id_is_zero_based_text(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "x int")
    got = sorted((r["x"], r["id"]) for r in ids.positional_id(df, [F.col("x")]).collect())
    assert got == [(10, "0"), (20, "1"), (30, "2")]


def test_null_rate_and_gate(spark):
    df = spark.createDataFrame([(None,), (1,), (None,), (2,)], "a int")
    r = quality.null_rate(df, "a").first()
    assert (r["null_count"], r["total_count"], r["null_pct"]) == (2, 4, 50.0)
    assert quality.gate_null_rate(df, "a")["null_pct"] == 50.0
    with pytest.raises(quality.DataQualityError):
        quality.gate_null_rate(df.union(spark.createDataFrame([(None,)], "a int")), "a")
    empty = spark.createDataFrame([], "a int")
    assert quality.null_rate(empty, "a").first()["null_pct"] == 0.0


def test_key_profile_and_gate(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,), ("b",)], "id string")
    r = quality.key_profile(df).first()
    assert (r["total_count"], r["null_ids"], r["duplicate_ids"]) == (6, 2, 3)
    with pytest.raises(quality.DataQualityError):
        quality.gate_keys(df)
    assert quality.gate_keys(spark.createDataFrame([("a",), ("b",)], "id string"))["duplicate_ids"] == 0


def test_column_tests(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y"), (None, "z")], "k int, v string")
    nn = {r["column_name"]: r["failures"] for r in quality.not_null_failures(df, ["k", "v"]).collect()}
    assert nn == {"k": 2, "v": 1}
    assert [(r["k"], r["n_records"]) for r in quality.unique_failures(df, "k").collect()] == [(1, 2)]


def test_union_by_name_and_backfill(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    u = frames.union_by_name([a, b])
    assert sorted(u.columns) == ["a", "b", "id"] and u.count() == 2
    schema = netex_record_schema("topographic_place")
    n = spark.createDataFrame([("7", "Name")], "ID string, Descriptor string")
    out = frames.backfill_columns(frames.ensure_version(frames.ensure_id(n)), schema)
    r = out.first()
    assert out.columns[:len(schema)] == schema.fieldNames()
    assert (r["id"], r["version"], r["Descriptor"], r["IsoCode"]) == ("7", None, "Name", None)
    assert isinstance(out.schema["IsoCode"].dataType, T.StringType)
    noid = frames.ensure_id(spark.createDataFrame([("b",), ("a",)], "v string"))
    assert sorted((r["v"], r["id"]) for r in noid.collect()) == [("a", "0"), ("b", "1")]

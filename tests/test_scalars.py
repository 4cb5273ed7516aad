"""Scalar functions (SCL-1..13)."""

import datetime as dt

from pyspark.sql import functions as F

from kollektiv.functions import scalars as S


def one(spark, expr_fn, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr_fn(F.col(df.columns[0]))).collect()]


def test_json_extract_string(spark):
    docs = ['{"Name":"x","n":1,"z":null}', '{"Other":"y"}', '{"Name":"x"', None]
    assert one(spark, lambda c: S.json_extract_string(c, "Name"), docs) == ["x", "", "", ""]
    assert one(spark, lambda c: S.json_extract_string(c, "z"), docs) == ["", "", "", ""]
    assert one(spark, lambda c: S.json_extract_string(c, "n"), docs)[0] == "1"          # lenient (D4)
    assert one(spark, lambda c: S.json_extract_string_strict(c, "n"), docs)[0] == ""    # strict (D4)
    assert one(spark, lambda c: S.json_extract_string_strict(c, "Name"), docs)[:2] == ["x", ""]


def test_pack_keeps_null_keys_and_non_ascii(spark):
    df = spark.createDataFrame([("Ö1", None)], "id string, version string")
    text = df.select(S.pack_json_payload(["id", "version"])).first()[0]
    assert text == '{"id":"Ö1","version":null}'


def test_cap_payload(spark):
    vals = ["abcdef", "abc", None]
    assert one(spark, lambda c: S.cap_payload(c, 4), vals) == ["abcd...[truncated]", "abc", None]
    assert S.PAYLOAD_CAP == 900_000


def test_location_text(spark):
    df = spark.createDataFrame([("1", "2"), (None, "2"), (None, None)], "lat string, lon string")
    assert [r[0] for r in df.select(S.location_text("lat", "lon")).collect()] == ["1,2", ",2", ","]


def test_parse_timestamp_forms(spark):
    vals = ["2025-10-27T21:54:00+01:00", "2025-10-27T21:54:00Z", "2025-10-27T21:54:00.123456-05:30",
            "2025-10-27T21:54:00", "2025-10-27 21:54:00+0100", "junk", "", None]
    got = one(spark, S.parse_timestamp, vals)
    assert got == [dt.datetime(2025, 10, 27, 20, 54), dt.datetime(2025, 10, 27, 21, 54),
                   dt.datetime(2025, 10, 28, 3, 24, 0, 123456), dt.datetime(2025, 10, 27, 21, 54),
                   dt.datetime(2025, 10, 27, 20, 54), None, None, None]


def test_parse_timestamp_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one(spark, S.parse_timestamp, ["2025-10-27T21:54:00+01:00", "2025-10-27T21:54:00"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2025, 10, 27, 20, 54), dt.datetime(2025, 10, 27, 21, 54)]


def test_parse_service_date(spark):
    vals = ["2025-10-27", "2025-10-27T00:30:00+01:00", "2025-10-27T23:30:00-05:00", "27/10/2025", None]
    assert one(spark, S.parse_service_date, vals) == [dt.date(2025, 10, 27)] * 3 + [None, None]


def test_service_date_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 10, 26, 23, 30),)], "t timestamp_ntz")
    assert df.select(S.service_date("t")).first()[0] == dt.date(2025, 10, 26)
    assert df.select(S.service_date("t", "Europe/Stockholm")).first()[0] == dt.date(2025, 10, 27)


def test_parse_double(spark):
    assert one(spark, S.parse_double, ["1", "1.5", "x", "", None, " 2 "]) == [1.0, 1.5, None, None, None, 2.0]


def test_first_non_empty(spark):
    df = spark.createDataFrame([("a", "r"), ("", "r"), (None, "r"), (None, None)], "t string, r string")
    assert [x[0] for x in df.select(S.first_non_empty("t", "r")).collect()] == ["a", "r", "r", None]


def test_fill_empty_strings(spark):
    df = spark.createDataFrame([(None, 1, None)], "a string, b int, c string")
    r = S.fill_empty_strings(df, ["a", "b", "missing"]).first()
    assert (r["a"], r["b"], r["c"]) == ("", "1", None)


def test_truncate_millis_and_run_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 0, 0, 999999),)], "t timestamp_ntz")
    assert df.select(S.truncate_millis("t")).first()[0] == dt.datetime(2025, 1, 1, 0, 0, 0, 999000)
    clock = S.run_clock(dt.datetime(2025, 1, 1, 1, 0, 0, 1500, tzinfo=dt.timezone(dt.timedelta(hours=1))),
                        "2025-01-01")
    r = spark.range(1).select(*[v.alias(k) for k, v in clock.items()]).first()
    assert r["Ingestion_Timestamp"] == dt.datetime(2025, 1, 1, 0, 0, 0, 1000)
    assert r["Ingestion_Date"] == dt.date(2025, 1, 1)


def test_partition_id(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 4),)], "d date")
    assert df.select(S.partition_id("d")).first()[0] == "2025-03-04"


def test_epoch_millis_ignores_session_zone(spark):
    want = int(dt.datetime(2025, 10, 27, 6, 0, 0, 123000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(dt.datetime(2025, 10, 27, 6, 0, 0, 123456),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(S.epoch_millis("t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want

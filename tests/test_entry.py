"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

from kollektiv.oracles import ORACLES  # noqa: E402
from kollektiv.registry import QUERIES  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "event_id" and len(df.columns) == 18


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[key])
    want = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(res.columns, want)[0]


@pytest.mark.parametrize("key", ["ingest_envelope", "src_siri_calls", "bronze_append_latest", "fact_movements",
                                 "parse_timestamp_coerce", "parse_date_fallback", "partition_overwrite"])
def test_results_do_not_depend_on_session_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = E.queries()[key](spark, SMOKE)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.sql(E.oracle_sql()[key])
    assert digest(df.columns, rows)[0] == digest(res.columns, res.fetchall())[0]

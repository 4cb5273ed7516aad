"""Registered queries against DuckDB at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import TABLES, digest  # noqa: E402

from kollektiv.llm.queries import ORACLES, QUERIES  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    import __spark_entry__ as E
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")) == list(range(1, 14))
    assert "pipeline" in QUERIES and set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = QUERIES[key](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLES[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert digest(df.columns, rows)[0] == digest(res.columns, res.fetchall())[0]

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def _prepared(spark):
    from kollektiv.llm.common import prepare
    prepare(spark)


@pytest.fixture(scope="session")
def smoke_docs():
    import duckdb
    return duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()

"""Queries against their SQL on small data."""

import os

import duckdb
import pytest
from check_queries import differences

from clickloom.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name, sf):
    folder = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        con.execute(f"create view {table} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], folder) is None

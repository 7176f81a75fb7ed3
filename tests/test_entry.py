"""Every registered query against the same query in SQL, on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from checks.oracle import all_statements
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def table_of(arrow):
    frame = arrow.select(sorted(arrow.column_names)).to_pandas().astype(object)
    types = {f.name: str(f.type).replace("large_", "") for f in arrow.schema}
    frame = frame.where(frame.notna(), None)
    return types, sorted(map(repr, frame.itertuples(index=False, name=None)))


def test_every_query_has_its_sql():
    assert QUERIES.keys() == all_statements().keys()
    assert QUERIES.keys() <= driver.queries().keys() and driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    got = table_of(driver.queries()[name](spark, SF_DIR).toArrow())
    want = table_of(duck.sql(driver.oracle_sql()[name]).to_arrow_table())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_flagship(spark):
    out = driver.entry(spark)
    assert "vendor_orphan_flag" in out.columns and not out.isEmpty()

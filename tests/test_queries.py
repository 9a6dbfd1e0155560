"""Every query against its SQL in DuckDB, over the smallest tables."""

import os

import duckdb
import pytest
from helpers import same_rows

from pairloom.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("events", "part", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    found = oracle.sql(ORACLE_SQL[name])
    same_rows(rows, df.columns, found.fetchall(), found.columns)


def test_entry_has_all_queries(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["item_id", "similar_item_id"]

"""Every registered query against its DuckDB oracle on the smallest driver
tables (row count, column names, order-insensitive value hash)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from roadlens.registry import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = ORACLE_SQL.get(name)
    assert sql is not None, "every registered query has an oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert digest(df.columns, got) == digest(ocols, exp)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 100 and "level" in df.columns


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())

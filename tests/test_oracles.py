"""Every query against DuckDB on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload import oracles
from workload import queries as ours

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_each_query_has_sql():
    assert set(ours.queries()) == set(oracles.oracle_sql()) and set(ORACLES) <= set(QUERIES)


def comparable(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([r[i] for i in order]) for r in records)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    sql = duck.execute(ORACLES[name])
    columns = [c[0] for c in sql.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.collect(), df.columns) == comparable(sql.fetchall(), columns)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0

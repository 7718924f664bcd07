"""Every registered query against its SQL statement, and the shape of its plan."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tripmart.plans.catalog import QUERIES
from tools.check_oracle import table_rows

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert QUERIES.keys() <= oracle_sql().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    table = queries()[name](spark, FOLDER)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "Python" not in plan
    got = table_rows(table.columns, [tuple(row) for row in table.collect()])
    result = duck.execute(oracle_sql()[name])
    assert got == table_rows([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 1

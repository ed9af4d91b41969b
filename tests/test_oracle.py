"""Every registered query against its SQL, on whole test tables."""

import datetime
import os

import pytest

import __spark_entry__ as entry_points
from workload.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def canonical(columns, rows):
    """Rows with columns in name order, as a sorted list of exact texts."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    got = result.collect()
    assert got
    sql = entry_points.oracle_sql()[name]
    cursor = duck.execute(sql)
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert canonical(result.columns, got) == canonical(columns, cursor.fetchall())


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["CustomerKey", "OrderDate", "NumOrders", "AvgOrdersPerDay"]
    assert result.limit(1).count() == 1


def test_every_workload_query_has_sql():
    assert set(ORACLES) == set(QUERIES)

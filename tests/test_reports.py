"""Every report against its SQL on the smallest tables, and a look at the plans."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ALIKE = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def as_text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


def sorted_rows(rows, columns, names):
    at = [columns.index(name) for name in sorted(names)]
    return sorted([as_text(row[i]) for i in at] for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = result.collect()
    if name not in contract.oracle_sql():
        assert rows
        return
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert sorted_rows(rows, result.columns, columns) == sorted_rows(expected, columns, columns)
    if expected:
        assert {f.name: ALIKE[f.dataType.simpleString()] for f in result.schema} == types


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_all_reports_have_sql_but_the_approximate_ones():
    without = set(QUERIES) - set(contract.oracle_sql())
    assert without == {"cell_search_recall", "embedded_documents", "nearest_points_by_cell"}

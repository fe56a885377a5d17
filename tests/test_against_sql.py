"""Every registered query against its SQL counterpart on DuckDB."""

import os

import duckdb
import pytest

from orderlens.oracle import oracle_columns, oracle_sql
from orderlens.registry import QUERIES, WITHOUT_SQL, run

FOLDER = os.environ.get("ORDERLENS_TEST_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "date": "date",
         "boolean": "boolean"}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(oracle_sql())


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in WITHOUT_SQL])
def test_equals_sql(name, spark, duck):
    df = run(name, spark, FOLDER)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == oracle_columns()[name]
    columns = df.columns
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()
    found = [tuple(row) for row in df.collect()]
    assert found
    assert _sorted(found) == _sorted(expected)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs_without_sql(name, spark):
    rows = run(name, spark, "/root/testdata/sf0.01").collect()
    assert rows and all(value is not None for row in rows for value in row)
    if name == "interval_coverage":
        assert abs(rows[0].coverage_pct - rows[0].level_pct) <= 5

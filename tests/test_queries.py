"""Every named query against its SQL in DuckDB."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tideline import oracle, registry  # noqa: E402
from tools.compare import rows_of  # noqa: E402


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    connection.sql("set timezone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(registry.QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1500


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, folder, name):
    result = contract.queries()[name](spark, folder)
    expected = db.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert rows_of(result.columns, result.collect()) == rows_of(expected.columns, expected.fetchall())

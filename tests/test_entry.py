import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, compare


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_reference_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_reference(spark, con, sf_dir, name):
    result = compare(spark, con, name, sf_dir)
    assert result.startswith(("ok", "rows only")) and "TYPES" not in result, result

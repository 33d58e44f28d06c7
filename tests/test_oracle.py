"""Every registered query with SQL gives the same rows as DuckDB; the others hold invariants."""

import pytest

import __spark_entry__ as contract
from compare import duckdb_tables, spark_side, sql_side

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_tables(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sf_dir, connection, name):
    names, rows = spark_side(QUERIES[name](spark, sf_dir))
    sql_names, sql_rows = sql_side(connection, ORACLE[name])
    assert names == sql_names
    assert rows and rows == sql_rows


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_gives_the_top_ten(spark):
    assert contract.entry(spark).count() == 10

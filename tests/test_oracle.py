"""Every registered query against its SQL in DuckDB on the same files."""

import duckdb
import pytest

import __spark_entry__ as driver
from twintally.catalogue import ORACLE_SQL, QUERIES
from twintally.catalogue.tables import TABLES, table

SPARK_KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE_SQL.items() <= driver.oracle_sql().items()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck, sf_dir):
    found = QUERIES[name](spark, sf_dir)
    wanted = duck.sql(ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    kinds = {c: SPARK_KIND[k] for c, k in found.dtypes}
    assert kinds == {c: str(t) for c, t in zip(wanted.columns, wanted.types)}
    wanted_rows = wanted.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    found_rows = [tuple(row) for row in found.select(*columns).collect()]
    assert found_rows, "no rows"
    assert ordered(found_rows) == ordered(wanted_rows)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 1 and rows[0].schema_match


@pytest.mark.parametrize("name", TABLES)
def test_stated_schemas_are_those_of_the_files(name, spark, sf_dir):
    assert table(spark, sf_dir, name).dtypes == spark.read.parquet(f"{sf_dir}/{name}.parquet").dtypes

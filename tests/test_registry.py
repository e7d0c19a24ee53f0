"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from compare import rows_of
from conftest import SF

import __spark_entry__ as contract
from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    mine = rows_of(df.columns, df.collect())
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == rows_of(columns, cursor.fetchall())

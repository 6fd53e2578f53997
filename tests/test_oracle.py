"""Every registered query against its SQL on DuckDB, on whole tables of the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import SMALL

STAR = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in STAR:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


OWN = list(entry_module.QUERIES)


def test_every_query_has_a_statement():
    assert set(OWN) <= set(entry_module.queries())
    assert set(OWN) <= set(entry_module.oracle_sql())
    assert len(OWN) == 32 + 17


@pytest.mark.parametrize("name", OWN)
def test_query_equals_statement(spark, duck, name):
    df = entry_module.queries()[name](spark, SMALL)
    cursor = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = sorted((tuple(map(plain, r)) for r in cursor.fetchall()), key=str)
    assert got == want
    assert want, "an empty result checks nothing"


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()
CLASH = "text string, row_key long, hub string, n long, votes string, unit long, w long"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with other columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, 7, "h", 1, "v", 2, 3) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, row_key long, hub string, n long, votes string, unit long, w long")

    return make

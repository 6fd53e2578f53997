import pytest

from tenderline.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from tenderline.sources import derive

    return derive(spark, SMALL)


def rows(df):
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)

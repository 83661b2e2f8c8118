import pytest

from tests.compare import duck, spark_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return spark_session()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duckdb_small():
    return duck(SMALL)

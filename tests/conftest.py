import os

import duckdb
import pytest

from bodega.session import build_session

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "bodega-tests", "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="4",
        spark__sql__sources__parallelPartitionDiscovery__parallelism="8",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def rows(df):
    """Rows as tuples, in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

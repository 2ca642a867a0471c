from pathlib import Path

import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tierlake.session import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def engine():
    """DuckDB with the smallest tables."""
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection

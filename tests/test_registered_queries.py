"""Every registered query against its SQL on the smallest tables."""

import math

import pytest

duckdb = pytest.importorskip("duckdb")

from tierlake.checks import all_checks  # noqa: E402
from tierlake.checks.sql_surface import _TABLES  # noqa: E402

CHECKS = all_checks()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in _TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else v
        return v if v is None or isinstance(v, (int, str)) else str(v)

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", CHECKS)
def test_query_agrees_with_sql(spark, tables, engine, name):
    check = CHECKS[name]
    frame = check.run(spark, tables)
    rows = frame.collect()
    if check.sql is None:
        assert rows
        return
    cursor = engine.execute(check.sql)
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert comparable(frame.columns, rows) == comparable(names, cursor.fetchall())

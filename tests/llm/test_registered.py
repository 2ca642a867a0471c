"""Registered queries of this package against their SQL on the smallest tables."""

import pytest

from test_registered_queries import comparable
from tierlake.llm.queries import CHECKS


@pytest.mark.parametrize("name", [n for n, c in CHECKS.items() if c.sql])
def test_query_agrees_with_sql(spark, tables, engine, name):
    frame = CHECKS[name].run(spark, tables)
    rows = frame.collect()
    cursor = engine.execute(CHECKS[name].sql)
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert comparable(frame.columns, rows) == comparable(names, cursor.fetchall())


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in CHECKS) == list(range(1, 14))

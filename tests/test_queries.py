"""Every query against its SQL, and that every query gives rows of a stable schema."""

from __future__ import annotations

import pytest
from conftest import SF, rows_of

from lakeshed.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    out = QUERIES[name](spark, SF)
    got = out.toPandas()
    if name in SQL:
        want = sql.execute(SQL[name]).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        assert rows_of(got, columns) == rows_of(want, columns)
    else:
        assert list(got.columns) == out.columns


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import database, differences

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in SQL:
        found = differences(frame, con, SQL[name])
        assert isinstance(found, tuple), found
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)

"""Every named query runs, and equals its SQL twin on the smallest tables."""

import pytest
from check import compare, duck, run

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF)
    if name in ORACLES:
        columns, _, rows = run(con, ORACLES[name])
        assert compare(result, columns, rows) > 0
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

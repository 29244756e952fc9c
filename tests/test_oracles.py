"""Every registered query on the small tables, against its oracle SQL where it has one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402

QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, small, name):
    got = QUERIES[name](spark, small).toPandas()
    if name in ORACLES:
        assert compare.difference(got, con.execute(ORACLES[name]).df()) is None
    else:
        assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0

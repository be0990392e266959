"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, db, sf, name):
    verdict, _, _ = compare(spark, db, sf, QUERIES[name], ORACLE[name])
    assert verdict == "ok"


def test_without_sql(spark, sf):
    for name in set(QUERIES) - set(ORACLE):
        assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 20

"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from devpulse.registry import ORACLE, QUERIES

FOLDER = contract.SMOKE_FOLDER
# its least number of events is above what the smallest tables have
MAY_BE_EMPTY = {"monthly_events"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    problem = difference(QUERIES[name](spark, FOLDER), duck, ORACLE[name])
    assert problem is None or (name in MAY_BE_EMPTY and problem == "no rows on either side")


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()

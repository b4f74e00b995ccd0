"""Every registered query against its SQL check on the smallest data set, as ``check.py`` does on larger data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bench import HEADLINE
from check import compare, connect
from settleflow.catalogue import REGISTRY

# the smallest data set has nothing these look for
EMPTY = set()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", list(REGISTRY))  # the text operators have their own tests
def test_query_agrees_with_sql(spark, duck, small, name):
    assert compare(spark, duck, small, name) == ("no rows" if name in EMPTY else "")


def test_headline_queries_are_registered():
    assert set(HEADLINE) <= set(REGISTRY)


def test_every_query_has_a_check():
    assert set(REGISTRY) <= set(queries()) and set(REGISTRY) <= set(oracle_sql())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0

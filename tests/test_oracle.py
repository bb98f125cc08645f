"""Every query against its SQL, value by value."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from claimflow import oracle, registry
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as e
from checks.compare import difference, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(e.queries()))
def test_query(spark, connection, name):
    if name in e.oracle_sql():
        assert difference(spark, connection, SF_DIR, e.queries()[name], e.oracle_sql()[name]) is None
    else:
        assert e.queries()[name](spark, SF_DIR).count() > 0

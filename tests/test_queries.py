"""Every registered query against its SQL on an independent engine."""

import os

import pytest

from tallymark.plans import ORACLES, QUERIES
from tests.compare import differences, reference_connection

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return reference_connection(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, key):
    problem, _ = differences(spark, connection, QUERIES[key], ORACLES.get(key), SF_DIR)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0

"""Every registered query against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from tests.check import TESTDATA, compare, connect

SF_DIR = os.path.join(TESTDATA, "sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF_DIR)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

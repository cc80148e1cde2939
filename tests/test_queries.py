"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from corpusmill.queries import QUERIES
from tests import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1

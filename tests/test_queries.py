"""Every registered query against its check on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from areastats import registry
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES, CHECKS = registry.QUERIES, registry.CHECKS


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, CHECKS[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0

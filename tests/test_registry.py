"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from saleslake.registry import all_queries, all_sql
from tests import oracle_compare as oc

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oc.connect(SF)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    found = oc.spark_rows(entry.queries()[name](spark, SF))
    assert oc.differences(found, oc.duckdb_rows(duck, entry.oracle_sql()[name])) is None

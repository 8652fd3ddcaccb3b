"""Every named query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from tallyline.plans.registry import QUERIES
from compare import assert_matches, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    assert_matches(spark, duck, SF_DIR, name)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

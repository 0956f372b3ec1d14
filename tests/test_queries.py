"""Registered queries against their SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import check_queries

import __spark_entry__ as entry
from strataglean.operators import recommend

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Streaming forms run several queries each; test_streams covers them on a small stream.
SLOW = {name for name in entry.queries() if name.startswith("stream_") and name != "stream_batches"}


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """Ten rounds of boosting instead of 500: the facts that are checked hold for any number."""
    defaults = recommend.fit_boosted_trees.__defaults__
    recommend.fit_boosted_trees.__defaults__ = (None, 10, *defaults[2:])
    yield
    recommend.fit_boosted_trees.__defaults__ = defaults


@pytest.fixture(scope="module")
def db():
    return check_queries.database(FOLDER)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, db, name):
    problem, _ = check_queries.compare(spark, db, FOLDER, name)
    assert problem == ""

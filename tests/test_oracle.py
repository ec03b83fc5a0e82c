"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest
from oracle import connect, duck_result, spark_result

import __spark_entry__ as entry_point
from driftlake.plans.registry import REGISTRY

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_point.queries())
    assert set(REGISTRY) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_sql(spark, duck, name):
    got = spark_result(entry_point.queries()[name](spark, SF_DIR))
    want = duck_result(duck, entry_point.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]


@pytest.mark.parametrize("name", [n for n in REGISTRY if n.startswith("m_")])
def test_merges_match_without_broadcast(spark, duck, settings, name):
    """The large-source way of merging gives the same rows."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    got = spark_result(entry_point.queries()[name](spark, SF_DIR))
    assert got == duck_result(duck, entry_point.oracle_sql()[name])


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["user_id", "event_type", "value", "props"]
    assert entry_point.entry(spark).count() > 0

"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from tidewell.registry.oracle import all_oracles
from tidewell.registry.queries import all_queries

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", all_oracles())
def test_query_matches_sql(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, ORACLES[name]) == []


def test_flagship_has_rows(spark, data):
    assert entry_points.entry(spark).columns == ["order_day", "total_orders", "revenue_aud", "aov_aud"]

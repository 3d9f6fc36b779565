"""Queries with SQL against DuckDB, on the test tables."""

import pytest

from compare import connect, differences
from tidewell.llm.registry import llm_oracles, llm_queries


@pytest.mark.parametrize("name", llm_oracles())
def test_query_matches_sql(spark, data, name):
    assert differences(llm_queries()[name](spark, data), connect(data), llm_oracles()[name]) == []

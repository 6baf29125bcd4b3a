"""Every registered query against DuckDB over the same tables."""

import pytest
from compare import difference

import __spark_entry__ as entry

# the queries of vitalspan/llm have their own tests in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, sf_dir, name):
    assert name in ORACLE, "a query without an oracle needs a test of its own"
    assert difference(QUERIES[name](spark, sf_dir), ORACLE[name], sf_dir) is None


def test_no_oracle_without_query():
    assert set(ORACLE) == set(QUERIES)


def test_entry_has_a_row_per_state(spark, sf_dir):
    result = entry.entry(spark)
    assert result.columns[0] == "iso_estado"
    assert 0 < result.count() <= 27

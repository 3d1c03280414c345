"""Every registered query against its DuckDB twin on sf0.001, plus entry()."""

import pytest

import __spark_entry__ as entry
from tests.oracle_harness import compare, duck, duck_rows, spark_rows
from windowlens.plans.oracle import oracle_sql
from windowlens.plans.registry import all_queries

QUERIES, SQL = all_queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_a_twin_or_is_rows_only():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql_twin(spark, small_dir, con, key):
    problems = compare(spark_rows(QUERIES[key](spark, small_dir)), duck_rows(con, SQL[key]))
    assert not problems, problems


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["window_start", "is_anomalous", "anomaly_type", "total_requests", "error_rate",
                          "avg_response_size", "p95_response_size"]

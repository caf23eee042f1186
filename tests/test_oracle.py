"""Every catalogue query with SQL must equal its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_compare import compare

SQL_KEYS = sorted(set(E.oracle_sql()) - set(E.LLM_QUERIES))


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF01, SQL_KEYS, verbose=False)


@pytest.mark.parametrize("name", SQL_KEYS)
def test_matches_oracle(results, name):
    assert results[name] == "OK", results[name]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_orders"] > 0
    assert df.columns == ["total_orders", "total_customers", "total_revenue", "avg_order_value"]


def test_every_query_registered_has_sql_or_is_ml():
    no_sql = set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES)
    assert no_sql == {"kmeans_profile", "kmeans_elbow"}

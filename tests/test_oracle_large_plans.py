"""The oracle check again with the join shapes of a large run.

Automatic broadcast and AQE are switched off and the checked broadcasts are
forced to their shuffle-join fallback, so every fact join is a sort-merge join
and the null-safe offset joins of the positional operators run as shuffles.
"""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_compare import compare

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
         }


@pytest.fixture(scope="module")
def results(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    try:
        return compare(spark, SF01, sorted(E.oracle_sql()), verbose=False)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_every_query_matches_with_shuffle_joins(results):
    bad = {k: v for k, v in results.items() if v != "OK"}
    assert not bad, bad

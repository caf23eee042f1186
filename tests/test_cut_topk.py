"""Top-k by counted values equals the rank window: ties, NULLs, hot groups, several orders."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import ranking
from quarry.plans.testdata import QUERIES
from tests.conftest import SF001


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_rank_window(spark, k, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a", "b", None]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5, 2.5, float(rng.randrange(8))]),
             rng.randrange(3)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, v double, w int")
    for values, order in ((["v"], [F.col("v").desc_nulls_last()]), (["v"], [F.col("v").asc_nulls_first()]),
                          (["w", "v"], [F.col("w").asc(), F.col("v").desc_nulls_last()])):
        want = ranking.topk_per_group(df, ["g"], order, k, keep_rank=True).select("id", "rank_in_group")
        got = ranking.topk_by_cut(df, ["g"], values, order, k, keep_rank=True).select("id", "rank_in_group")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        plain = ranking.topk_by_cut(df, ["g"], values, order, k)
        assert plain.columns == df.columns and sorted(r.id for r in plain.collect()) == sorted(r.id for r in want.collect())


def test_hot_group_with_one_shared_value_keeps_every_tie(spark):
    df = spark.range(0, 30000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
                                      F.when(F.col("id") % 3 == 0, 9.0).otherwise(F.col("id") % 50 + 0.0).alias("v"))
    got = ranking.topk_by_cut(df, ["g"], ["v"], [F.col("v").desc()], 2)
    assert got.filter("g = 'hot'").count() == 10000
    assert got.exceptAll(ranking.topk_per_group(df, ["g"], [F.col("v").desc()], 2)).count() == 0
    assert ranking.topk_by_cut(df.limit(0), ["g"], ["v"], [F.col("v").desc()], 2).count() == 0


def test_counts_may_come_weighted(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 4, 1), ("a", 3, 7), ("a", 2, 1), ("b", 1, 9)], "g string, v int, n long")
    kept = ranking.kept_values(df, ["g"], ["v"], [F.col("v").desc()], 3, weight="n")
    assert sorted(map(tuple, kept.collect())) == [("a", 3, 3), ("a", 4, 2), ("a", 5, 1), ("b", 1, 1)]


def test_no_window_over_lines(spark):
    """Lines are aggregated before the window, and its values are limited before their shuffle."""
    df = QUERIES["topk_per_group"](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert "Aggregate [category" in window and "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()

"""Hot keys (one key with a third of all rows) give the same answers as the naive plans."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import fanout, groups, growth, positions


@pytest.fixture(scope="module")
def skewed(spark):
    n = 6000
    # order 0 holds a third of all items and a third of all reviews
    items = spark.range(0, n).select(
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("o"),
        (F.col("id") % 7).alias("i"), (F.col("id") % 97 + 1).cast("double").alias("price"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("g"))
    reviews = spark.range(0, 900).select(
        F.when(F.col("id") < 300, F.lit(0)).otherwise(F.col("id") % 50).alias("o"),
        (F.col("id") % 5 + 1).cast("int").alias("score"))
    return items, reviews


def test_fanout_on_hot_order_equals_joined_rows(skewed):
    items, reviews = skewed
    fast = {r.g: r for r in fanout.fanout_summary(
        fanout.review_weights(items, reviews, "o", "o", "score"), ["g"], "o", "i", "price").collect()}
    naive = {r.g: r for r in items.join(reviews.withColumnRenamed("o", "ro"), F.col("o") == F.col("ro"), "left")
             .groupBy("g").agg(F.countDistinct("o").alias("orders"), F.count("i").alias("items_sold"),
                               F.sum("price").alias("revenue"), F.avg("score").alias("avg_rating")).collect()}
    for g in naive:
        assert (fast[g].orders, fast[g].items_sold) == (naive[g].orders, naive[g].items_sold)
        assert fast[g].revenue == pytest.approx(naive[g].revenue, abs=0.006)
        assert fast[g].avg_rating == pytest.approx(naive[g].avg_rating, abs=0.006)


def test_hot_person_distinct_counts_and_cohorts(spark):
    rows = spark.range(0, 9000).select(
        F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id") % 300).alias("p"),
        F.col("id").alias("o"),
        F.expr("date_add(DATE'2020-01-01', cast(id % 400 as int))").alias("d"),
        F.lit(1.0).alias("amt"))
    k = groups.kpi_summary(rows, "o", "p", "amt").first()
    want = rows.agg(F.countDistinct("o"), F.countDistinct("p")).first()
    assert (k.total_orders, k.total_customers) == (want[0], want[1])
    co = growth.cohort_activity(rows, "p", "d")
    naive = (rows.select("p", F.trunc("d", "MM").alias("m"))
             .join(rows.groupBy("p").agg(F.min(F.trunc("d", "MM")).alias("c")), "p")
             .groupBy("c", F.months_between("m", "c").cast("long").alias("idx"))
             .agg(F.countDistinct("p").alias("n")))
    got = {(r.cohort_month, r.month_index): r.active_customers for r in co.collect()}
    assert got == {(r.c, r.idx): r.n for r in naive.collect()}


def test_ntile_with_one_hot_value(spark):
    """A third of all rows share one sort value; the tie-break spreads them."""
    df = spark.range(0, 3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("v"))
    order = [F.col("v").asc(), F.col("id").asc()]
    got = positions.ntile_global(df, 4, order, "t", num_partitions=8)
    assert got.groupBy("t").count().agg(F.min("count"), F.max("count")).first() == (750, 750)
    from pyspark.sql import Window
    want = df.withColumn("w", F.ntile(4).over(Window.orderBy(*order)))
    assert got.join(want, "id").filter(F.col("t") != F.col("w")).count() == 0


def test_positions_and_outliers_without_broadcast(spark):
    """Beyond the broadcast bound the same results come from shuffle joins."""
    from pyspark.sql import Window
    from quarry.operators import distribution
    df = spark.range(0, 2000).select("id", (F.col("id") % 5).cast("string").alias("g"),
                                     F.when(F.col("id") == 7, 10000.0).otherwise(F.col("id") % 50 + 1.0).alias("v"))
    # over the bound the join is left to Spark's size-based choice; switch that off too
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        pos = positions.with_positions(df, [F.col("v").asc(), F.col("id").asc()], by=["g"], num_partitions=6)
        plan = pos._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r._pos for r in pos.collect()}
        out = distribution.group_outliers(df, ["g"], "v", factor=10.0, min_count=20).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan  # the offsets are joined by a shuffle join, not broadcast
    w = Window.partitionBy("g").orderBy("v", "id")
    want = {r.id: r.p for r in df.select("id", F.row_number().over(w).alias("p")).collect()}
    assert got == want
    default = distribution.group_outliers(df, ["g"], "v", factor=10.0, min_count=20).collect()
    assert [(r.id, r.median_value, r.x_median) for r in out] == \
        [(r.id, r.median_value, r.x_median) for r in default] == [(7, 28.0, 357.1)]

"""Unit and property tests for the column helpers and operators (the §1.4 traps)."""

import datetime as dt

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import correlation, explode, explorer, groups, growth, positions, ranking, reshape

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


# ----------------------------------------------------------------------------- helpers

def test_sentinel_excluded_from_average_not_from_count(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 4.0), ("a", 3.0), ("b", 0.0)], "g string, r double")
    out = groups.group_profile(df, ["g"], [X.avg_where("r", F.col("r") > 0).alias("avg_r")],
                               count_name="n").orderBy("g").collect()
    assert [(r.g, r.n, r.avg_r) for r in out] == [("a", 3, 3.5), ("b", 1, None)]


def test_split_is_literal_and_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a.b,,c",), (None,)], "s string")
    dot = explode.explode_tokens(df, "s", ".", "t").collect()
    assert sorted(r.t for r in dot) == ["a", "b,,c"]
    comma = explode.explode_tokens(df, "s", ",", "t").collect()
    assert sorted(r.t for r in comma) == ["", "a.b", "c"]


def test_month_index_counts_boundaries_and_day_diff_counts_midnights(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 31, 23, 0), dt.datetime(2020, 2, 1, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.month_index("a", "b").alias("m"), X.day_diff("a", "b").alias("d")).first()
    assert (r.m, r.d) == (1, 1)


def test_zero_divisor_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r.q for r in df.select(X.safe_divide("a", "b").alias("q")).collect()] == [None, 0.5]


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (None, 5.0)], "x double, y double")
    r = correlation.correlations(df, {"c": ("x", "y")}).first()
    assert r.c is None


def test_correlation_ignores_rows_with_a_null_side(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (4.0, None), (None, 3.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = correlation.correlations(df, {"c": ("x", "y")}, digits=None).first().c
    want = duckdb.sql("select corr(x, y) from (values (1.0,2.0),(2.0,4.1),(3.0,5.9),(4.0,NULL),(NULL,3.0)) t(x,y)"
                      ).fetchall()[0][0]
    assert got == pytest.approx(want, rel=1e-12)


def test_numeric_text_guard(spark):
    vals = ["4.5", " 7 ", "4d", "1f", "No rating available", "", None, "-2e3", ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.v for r in df.select(X.safe_double("s").alias("v")).collect()]
    assert got == [4.5, 7.0, None, None, None, None, None, -2000.0, 0.5]


def test_bracketed_path_segment(spark):
    df = spark.createDataFrame([('["Clothing >> Women >> Tops"]',), ('["Home"]',)], "p string")
    got = [r.c for r in df.select(X.path_segment("p", ">>", 1).alias("c")).collect()]
    assert got == ["Clothing", "Home"]


def test_tier_bin_and_counts_sum_to_rows(spark):
    df = spark.range(0, 1000).select((F.col("id") * 17 % 12000).cast("double").alias("price"))
    tiers = [(500, "1"), (2000, "2"), (10000, "3")]
    out = groups.group_profile(df.withColumn("t", X.tier_bin("price", tiers, "4")), ["t"], [], count_name="n")
    assert sum(r.n for r in out.collect()) == 1000


def test_rate_pct_is_double(spark):
    df = spark.createDataFrame([(1,), (0,), (1,)], "late int")
    out = df.agg(X.rate_pct(F.col("late") == 1, 1).alias("p"))
    assert dict(out.dtypes)["p"] == "double" and out.first().p == 66.7


# ----------------------------------------------------------------------------- ranking / explorer

def test_rank_keeps_ties_and_nulls_sort_last(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("a", 5.0), ("a", 4.0), ("a", None), ("b", None)],
                               "g string, x double")
    top = ranking.topk_per_group(df, ["g"], [F.col("x").desc_nulls_last()], 3).collect()
    assert sorted((r.g, r.x) for r in top if r.g == "a") == [("a", 5.0)] * 3
    assert [(r.g, r.x) for r in top if r.g == "b"] == [("b", None)]


def test_optional_parameter_none_equals_no_filter(spark):
    df = spark.range(0, 50).withColumn("c", (F.col("id") % 3).cast("string"))
    a = explorer.filtered_explorer(df, [("c", "=", None), ("id", ">=", None)], [F.col("id").desc()], 200)
    assert a.count() == 50
    b = explorer.filtered_explorer(df, [("c", "=", "1"), ("id", ">=", 10)], [F.col("id").desc()], 200)
    assert sorted(r.id for r in b.collect()) == [i for i in range(10, 50) if i % 3 == 1]


# ----------------------------------------------------------------------------- positions (NTILE / quantiles)

@SETTINGS
@given(values=st.lists(st.integers(min_value=0, max_value=5), min_size=1, max_size=60),
       k=st.integers(min_value=1, max_value=6))
def test_ntile_global_equals_sql_ntile(spark, values, k):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r.id: r.t for r in positions.ntile_global(df, k, order, "t", num_partitions=4).collect()}
    want = {r.id: r.t for r in df.withColumn("t", F.ntile(k).over(Window.orderBy(*order))).collect()}
    assert got == want
    sizes = {}
    for t in got.values():
        sizes[t] = sizes.get(t, 0) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 1


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 20)), min_size=1, max_size=50))
def test_group_positions_within_groups(spark, rows):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g string, v long")
    order = [F.col("v").asc(), F.col("id").asc()]
    got = {r.id: (r._pos, r._n) for r in positions.with_positions(df, order, by=["g"], num_partitions=3).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    want = {r.id: (r.p, r.n) for r in df.select("id", F.row_number().over(w).alias("p"),
                                                 F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n")).collect()}
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 1000)), min_size=1, max_size=60))
def test_group_quantiles_equal_percentile_cont(spark, rows):
    data = [(g, v / 100.0) for g, v in rows]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: (r.q1, r.med, r.q3) for r in
           positions.group_quantiles(df, ["g"], "v", {"q1": 0.25, "med": 0.5, "q3": 0.75}, num_partitions=3).collect()}
    con = duckdb.connect()
    con.execute("create table t(g varchar, v double)")
    con.executemany("insert into t values (?, ?)", data)
    want = {g: (a, b, c) for g, a, b, c in con.execute(
        "select g, quantile_cont(v, 0.25), quantile_cont(v, 0.5), quantile_cont(v, 0.75) from t group by g").fetchall()}
    assert got.keys() == want.keys()
    for g in got:
        assert got[g] == pytest.approx(want[g], abs=1e-9)


def test_positions_spread_a_hot_group(spark):
    """One group holding most rows is split over several range partitions."""
    df = spark.range(0, 4000).select(F.col("id"), F.when(F.col("id") < 3000, "hot").otherwise(
        (F.col("id") % 7).cast("string")).alias("g"))
    pos = positions.with_positions(df, [F.col("id").asc()], by=["g"], num_partitions=8)
    hot = pos.filter(F.col("g") == "hot")
    assert hot.agg(F.min("_pos"), F.max("_pos"), F.countDistinct("_pos")).first() == (1, 3000, 3000)
    parts = hot.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 4


# ----------------------------------------------------------------------------- growth / cohorts / reshape

def test_period_growth_lag_and_filter_after_lag(spark):
    rows = [(1, 10, dt.datetime(2020, 1, 5), 100.0), (2, 10, dt.datetime(2020, 2, 5), 150.0),
            (3, 11, dt.datetime(2020, 2, 9), 50.0), (4, 11, dt.datetime(2020, 3, 1), 0.0)]
    df = spark.createDataFrame(rows, "o long, c long, ts timestamp_ntz, amt double")
    out = growth.period_growth(df, "ts", "amt", "o", "c", from_period="2020-02-01").collect()
    assert [(r.month.month, r.revenue, r.prev_month_revenue, r.mom_growth_pct) for r in out] == [
        (2, 200.0, 100.0, 100.0), (3, 0.0, 200.0, -100.0)]
    assert out[0].order_count == 2 and out[0].unique_customers == 2


def test_cohort_index_zero_is_cohort_size(spark):
    rows = [(1, dt.datetime(2020, 1, 31)), (1, dt.datetime(2020, 2, 1)), (1, dt.datetime(2020, 2, 20)),
            (2, dt.datetime(2020, 2, 3)), (3, dt.datetime(2020, 1, 2))]
    df = spark.createDataFrame(rows, "p long, ts timestamp_ntz")
    co = growth.cohort_activity(df, "p", "ts")
    got = {(r.cohort_month.month, r.month_index): r.active_customers for r in co.collect()}
    assert got == {(1, 0): 2, (1, 1): 1, (2, 0): 1}
    pct = {(r.cohort_month.month, r.month_index): r.retention_pct for r in growth.retention_pct(co).collect()}
    assert pct[(1, 0)] == 100.0 and pct[(1, 1)] == 50.0


def test_repeat_rate(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 12)], "p long, o long")
    r = growth.repeat_rate(df, "p", "o").first()
    assert (r.total_customers, r.repeat_customers, r.repeat_purchase_rate_pct) == (2, 1, 50.0)


def test_profile_melt_and_pivot(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3.0, None)], "a long, b double, c string")
    prof = {r.column_name: (r.dtype, r.non_null_count, r.row_count) for r in reshape.table_profile(df).collect()}
    assert prof == {"a": ("bigint", 2, 2), "b": ("double", 1, 2), "c": ("string", 1, 2)}
    miss = [(r.column_name, r.null_count) for r in reshape.missing_counts(df).collect()]
    assert sorted(miss) == [("b", 1), ("c", 1)]
    long = spark.createDataFrame([("r1", "m1", 1.0), ("r1", "m2", 2.0), ("r2", "m1", 3.0)], "r string, m string, v double")
    wide = {r.r: (r.m1, r.m2) for r in reshape.pivot_wide(long, "r", "m", "v", ["m1", "m2"]).collect()}
    assert wide == {"r1": (1.0, 2.0), "r2": (3.0, None)}
    back = reshape.melt(reshape.pivot_wide(long, "r", "m", "v", ["m1", "m2"]), ["r"], ["m1", "m2"], "m", "v")
    assert back.filter(F.col("v").isNotNull()).count() == 3


def test_kpi_summary_equals_distinct_counts(spark):
    rows = [(1, 7, 10.0), (1, 7, 5.0), (2, 7, 1.0), (3, 8, 2.5), (4, None, 1.0)]
    df = spark.createDataFrame(rows, "o long, p long, amt double")
    r = groups.kpi_summary(df, "o", "p", "amt").first()
    want = df.agg(F.countDistinct("o"), F.countDistinct("p"), F.sum("amt")).first()
    assert (r.total_orders, r.total_customers, r.total_revenue) == (want[0], want[1], want[2])
    assert r.avg_order_value == round(want[2] / want[0], 2)


def test_distribution_exact_and_approx_agree_on_small_groups(spark):
    from quarry.operators import distribution
    rows = [("a", float(v)) for v in range(1, 102)] + [("b", 5.0), ("b", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    ex = {r.g: r for r in distribution.distribution_by_group(df, ["g"], "v").collect()}
    ap = {r.g: r for r in distribution.distribution_by_group(df, ["g"], "v", exact=False).collect()}
    assert (ex["a"]["count"], ex["a"].median_value, ex["a"].q1, ex["a"].q3) == (101, 51.0, 26.0, 76.0)
    assert ex["b"].median_value == 6.0 and ex["b"].value_range == 2.0
    assert ap["a"].median_value == 51.0 and ap["b"]["count"] == 2


def test_fanout_dedupe_counts_each_item_once(spark):
    from quarry.operators import fanout
    items = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (2, 1, 5.0)], "o long, i long, price double")
    reviews = spark.createDataFrame([(1, 5), (1, 3), (1, None)], "o long, score int")
    items = items.withColumn("g", F.lit("all"))
    faithful = fanout.fanout_summary(fanout.review_weights(items, reviews, "o", "o", "score"),
                                     ["g"], "o", "i", "price").first()
    # order 1 has 3 review rows: its two items count 3 times each; the NULL score is not averaged
    assert (faithful.orders, faithful.items_sold, faithful.revenue) == (2, 7, 95.0)
    assert faithful.avg_rating == 4.0
    deduped = fanout.fanout_summary(fanout.review_weights(items, reviews, "o", "o", "score", dedupe=True),
                                    ["g"], "o", "i", "price").first()
    assert (deduped.items_sold, deduped.revenue) == (3, 35.0)


def test_kpi_summary_approximate_persons(spark):
    df = spark.range(0, 3000).select((F.col("id") % 1000).alias("o"), (F.col("id") % 1000 % 400).alias("p"),
                                     F.lit(1.0).alias("amt"))
    exact = groups.kpi_summary(df, "o", "p", "amt").first()
    approx = groups.kpi_summary(df, "o", "p", "amt", approx_persons=0.01).first()
    assert (exact.total_orders, exact.total_customers) == (1000, 400)
    assert approx.total_orders == 1000 and abs(approx.total_customers - 400) <= 16
    assert approx.total_revenue == exact.total_revenue == 3000.0


def test_rounding_matches_the_sql_engine_bit_for_bit(spark):
    """sql_round / half_even_round equal DuckDB round / round_even, ties and -0.0 included."""
    import math
    vals = [4201.315, 12.35, 2.675, -2.675, 0.125, -0.004, 1.005, 1234.5, -0.5, 25.45, 0.0625, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for d in (0, 1, 2, 3):
        got = [(r.a, r.b) for r in df.select(X.sql_round("v", d).alias("a"),
                                             X.half_even_round("v", d).alias("b")).collect()]
        want = duckdb.sql(f"select round(v, {d}), round_even(v, {d}) from (select unnest({vals}::double[]) as v)"
                          ).fetchall()
        for (a, b), (wa, wb) in zip(got, want):
            assert (a, math.copysign(1, a)) == (wa, math.copysign(1, wa))
            assert (b, math.copysign(1, b)) == (wb, math.copysign(1, wb))


def test_positional_operators_on_empty_input(spark):
    from quarry.operators import distribution, rfm
    empty = spark.range(0, 10).filter(F.col("id") < 0).select("id", (F.col("id") % 2).cast("string").alias("g"),
                                                               F.col("id").cast("double").alias("v"))
    assert positions.ntile_global(empty, 4, [F.col("v").asc(), F.col("id").asc()], "t").count() == 0
    assert positions.group_quantiles(empty, ["g"], "v", {"m": 0.5}).count() == 0
    assert distribution.group_outliers(empty, ["g"], "v").count() == 0
    orders = empty.select(F.col("id").alias("c"), F.current_date().alias("d"), F.col("v").alias("amt"))
    assert rfm.customer_rfm(orders, "c", "d", "amt").count() == 0

"""Sketch-guided quantiles and tiles against plain sorting, with ties, nulls, NaN, hot groups and tiny brackets."""

import math
import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import selection

PROBS = {"q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99}


def cont(values, p):
    s = sorted(values)
    h = (len(s) - 1) * p
    lo = math.floor(h)
    return s[lo] + (h - lo) * (s[math.ceil(h)] - s[lo])


def groups_of(rows):
    out = {}
    for g, v in rows:
        out.setdefault(g, [])
        if v is not None:
            out[g].append(v)
    return out


def check_quantiles(spark, rows, **options):
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r for r in selection.group_quantiles(df, ["g"], "v", PROBS, aggs=[F.count("*").alias("rows")], **options).collect()}
    want = groups_of(rows)
    assert got.keys() == want.keys()
    for g, values in want.items():
        assert got[g]["rows"] == sum(x == g for x, _ in rows)
        for name, p in PROBS.items():
            assert got[g][name] == (pytest.approx(cont(values, p), rel=1e-12, abs=1e-12) if values else None), (g, name)


def mixed(n, seed):
    r = random.Random(seed)
    rows = [("hot", r.gauss(0, 100)) for _ in range(n)]                    # a continuous group with most rows
    rows += [("ties", r.choice([1.0, 2.0, 2.0, 2.0, 7.0])) for _ in range(n // 2)]   # few distinct values
    rows += [(None, r.random()) for _ in range(n // 4)] + [("small", float(i)) for i in range(7)] + [("one", 3.5), ("none", None), ("small", None)]
    return rows + [("skewed", 10.0 ** r.uniform(-300, 300)) for _ in range(n // 4)]


@pytest.mark.parametrize("inside,small_group", [(1_000_000, 20_000), (1_000_000, 100), (200, 100), (1, 0)])
def test_quantiles_with_brackets_of_any_size(spark, inside, small_group):
    check_quantiles(spark, mixed(6000, inside + small_group), inside=inside, small_group=small_group)


def test_wrong_sketches_are_found_out(spark, monkeypatch):
    """Brackets that miss the rank are widened until the counts prove them."""
    monkeypatch.setattr(selection, "_sketch", lambda value: F.when(F.count(value) > 0, F.array(*[F.lit(i / 1e6) for i in range(selection.CELLS + 1)])))
    check_quantiles(spark, mixed(1500, 3), small_group=10)
    check_quantiles(spark, mixed(1500, 4), small_group=10, inside=50)


def test_infinities_and_nan_are_ordered(spark):
    rows = [("a", v) for v in (float("-inf"), float("-inf"), 0.0, 1.0, float("inf"))] * 100 + [("b", float("nan"))] * 3 + [("b", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for small in (0, 1000):
        got = {r["g"]: r for r in selection.group_quantiles(df, ["g"], "v", {"low": 0.0, "med": 0.5, "high": 1.0}, small_group=small).collect()}
        assert got["a"]["med"] == 0.0 and math.isnan(got["b"]["high"]) and math.isnan(got["b"]["med"])


def test_decimal_interpolation_is_exact_and_never_rounds_silently(spark):
    df = spark.createDataFrame([("a", 1.01), ("a", 1.02), ("b", 0.1234567), ("b", 2.0)], "g string, v double")
    got = selection.group_quantiles(df.filter("g = 'a'"), ["g"], "v", {"med": 0.5}, decimal_scale=6).first()
    assert str(got["med"]).rstrip("0") == "1.015"
    with pytest.raises(Exception, match="digits behind the point"):
        selection.group_quantiles(df, ["g"], "v", {"med": 0.5}, decimal_scale=6).collect()
    assert selection.group_quantiles(df, ["g"], "v", {"med": 0.5}, decimal_scale=9).count() == 2


def test_quantiles_without_groups_and_of_nothing(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("v"))
    assert selection.group_quantiles(df, [], "v", {"med": 0.5}, small_group=10).first()["med"] == 500.5
    assert selection.group_quantiles(df.filter("v < 0").withColumn("g", F.lit("a")), ["g"], "v", {"med": 0.5}).collect() == []


def test_the_input_is_neither_sorted_nor_range_partitioned(spark):
    df = spark.range(0, 50_000).select((F.col("id") % 3).alias("g"), F.rand(7).alias("v"))
    plan = selection.group_quantiles(df, ["g"], "v", {"med": 0.5}, small_group=100)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Range (" not in plan   # what is left reads the counted values only


# --- tiles

ORDERS = {"a": [("v", "desc"), ("id", "asc")], "b": [("f", "asc"), ("name", "desc"), ("id", "asc")], "c": [("id", "asc")], "d": [("dec", "asc"), ("id", "desc")]}


def sort_columns(order):
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in order]


def tile_rows(n, seed):
    r = random.Random(seed)
    names = ["", "a", "ab", "prefix shared by all of them 1", "prefix shared by all of them 2", "é", "zebra", None]
    special = [None, float("nan"), float("inf"), float("-inf"), 0.0]
    return [(i * 3 - n, r.choice(special) if r.random() < 0.1 else round(r.random(), 1), r.randint(0, 2), r.choice(names), str(r.randint(0, 3)) + ".0000000000000000001") for i in range(n)]


@pytest.mark.parametrize("n,k,inside", [(1, 4, 10), (3, 4, 10), (40, 4, 10**6), (600, 4, 10**6), (300, 5, 20), (301, 1, 20), (2000, 3, 100)])
def test_tiles_equal_sql_ntile_in_every_order(spark, n, k, inside):
    df = spark.createDataFrame(tile_rows(n, n + k), "id long, v double, f int, name string, dec string").withColumn("dec", F.col("dec").cast("decimal(38,19)")).repartition(4).cache()
    got = selection.ntiles(df, k, ORDERS, inside=inside)
    for name, order in ORDERS.items():
        got = got.withColumn(f"want_{name}", F.ntile(k).over(Window.orderBy(*sort_columns(order))))
    rows = got.collect()
    for name in ORDERS:
        wrong = [(r["id"], r[name], r[f"want_{name}"]) for r in rows if r[name] != r[f"want_{name}"]]
        assert not wrong, (name, wrong[:5])


def test_tiles_of_nothing_and_of_extreme_ids(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert selection.ntiles(empty, 4, {"t": [("v", "asc"), ("id", "asc")]}).collect() == []
    ids = [-(1 << 63), -(1 << 62) - 1, -(1 << 62), -1, 0, 1, (1 << 62), (1 << 62) + 1, (1 << 63) - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert [r["t"] for r in selection.ntiles(df, 3, {"t": [("id", "asc")]}).orderBy("id").collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3]


def test_tiles_add_no_shuffle(spark):
    df = spark.range(0, 1000).withColumn("v", F.col("id") % 7)
    plan = selection.ntiles(df, 4, {"t": [("v", "asc"), ("id", "asc")], "u": [("v", "desc"), ("id", "asc")]})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_quantiles_equal_another_engine(spark):
    rows = mixed(3000, 8)
    df = spark.createDataFrame(rows, "g string, v double")
    con = duckdb.connect()
    con.execute("create table t(g varchar, v double)")
    con.executemany("insert into t values (?, ?)", [r for r in rows if r[0] not in (None, "none")])
    want = {g: m for g, m in con.execute("select g, quantile_cont(v, 0.5) from t group by g").fetchall()}
    got = {r["g"]: r["m"] for r in selection.group_quantiles(df.filter("g <> 'none'"), ["g"], "v", {"m": 0.5}, small_group=50, inside=500).collect()}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g], rel=1e-12) for g in want)

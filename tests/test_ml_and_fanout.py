"""MLlib steps against numpy, and the arithmetic review fan-out against a real join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import ml
from quarry.plans import testdata as T
from tests.conftest import SF001


def test_ols_matches_lstsq_and_residuals_center(spark):
    l = spark.read.parquet(f"{SF001}/lineitem.parquet")
    model, scored, r2 = ml.ols_fit(l, "l_extendedprice", T.OLS_FEATURES, log_label=True)
    pdf = l.select(*T.OLS_FEATURES, "l_extendedprice").toPandas()
    pdf = pdf[pdf.l_extendedprice > 0]
    X = np.column_stack([np.ones(len(pdf)), pdf[T.OLS_FEATURES].to_numpy()])
    y = np.log(pdf.l_extendedprice.to_numpy())
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert model.intercept == pytest.approx(beta[0], rel=1e-6, abs=1e-9)
    assert list(model.coefficients) == pytest.approx(list(beta[1:]), rel=1e-6, abs=1e-9)
    resid = y - X @ beta
    assert r2 == pytest.approx(1 - resid.var() / y.var(), rel=1e-6)
    assert scored.agg(F.sum("residual")).first()[0] == pytest.approx(0.0, abs=1e-6)


def test_residual_extremes_are_the_ends(spark):
    l = spark.read.parquet(f"{SF001}/lineitem.parquet")
    _, scored, _ = ml.ols_fit(l, "l_extendedprice", T.OLS_FEATURES)
    ext = ml.residual_extremes(scored, 5, ["l_orderkey"]).collect()
    res = sorted(r.residual for r in scored.select("residual").collect())
    assert sorted(r.residual for r in ext if r.side == "under") == res[:5]
    assert sorted(r.residual for r in ext if r.side == "over") == res[-5:]


def test_moments_of_loads_merge_to_those_of_all_rows(spark):
    """Three loads, one of them empty, merged, give the fit of all rows; columns may depend on each other."""
    df = spark.range(0, 3000).select((F.rand(1) * 50).alias("a"), (F.rand(2) + 1e6).alias("b"), F.when(F.col("id") % 50 > 0, F.rand(3)).alias("y"), "id")
    cols = ["a", "b", "y"]
    parts = [ml.co_moments(df.filter(f"id {cond}"), cols) for cond in ("< 100", "between 100 and 2999", "> 5000")]
    merged = ml.merge_co_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]), 3).first()
    whole = ml.co_moments(df, cols).first()
    assert merged["n"] == whole["n"] == 2940
    assert merged["means"] == pytest.approx(whole["means"], rel=1e-12) and merged["moments"] == pytest.approx(whole["moments"], rel=1e-9, abs=1e-6)
    twice = df.withColumn("c", F.col("a") * 2)
    fit, scored, r2 = ml.ols_fit(twice.withColumn("t", F.col("a") * 3 + 5), "t", ["a", "c"], log_label=False)
    assert r2 == pytest.approx(1.0) and scored.agg(F.max(F.abs("residual"))).first()[0] < 1e-8
    empty = ml.ols_fit(df.filter("id < 0"), "y", ["a"], log_label=False)
    assert np.isnan(empty[0].intercept) and empty[1].count() == 0


def test_assignment_to_given_centres(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.5, 0.0), (9.0, 9.0), (None, 1.0)], "x double, y double")
    rows = ml.assign(df, ["x", "y"], [(0.0, 0.0), (1.0, 0.0), (9.0, 9.0)], distance="d").collect()
    assert [(r["cluster"], r["d"]) for r in rows] == [(0, 0.0), (1, 0.0), (0, 0.25), (2, 0.0), (None, None)]


def test_population_standardisation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (6.0,)], "x double")
    z = np.array([r.x_z for r in ml.standardize(df, ["x"]).collect()])
    assert z.mean() == pytest.approx(0.0, abs=1e-12) and z.std() == pytest.approx(1.0)


def test_kmeans_best_and_elbow(spark):
    l = spark.read.parquet(f"{SF001}/lineitem.parquet").select(*T.KMEANS_FEATURES)
    _, assigned, cost = ml.kmeans_best(l, T.KMEANS_FEATURES, 3, n_init=3)
    assert assigned.select("cluster").distinct().count() == 3
    prof = ml.cluster_profile(assigned, T.KMEANS_FEATURES)
    assert prof.agg(F.sum("size")).first()[0] == l.count()
    elbow = [r.inertia for r in ml.elbow_curve(l, T.KMEANS_FEATURES, [2, 3, 4, 5], n_init=3).orderBy("k").collect()]
    assert all(b <= a * 1.02 for a, b in zip(elbow, elbow[1:]))
    assert min(elbow) <= cost <= max(elbow)


def test_one_job_per_iteration_serves_all_fits(spark):
    """Fits of several k share their passes, and each ends where MLlib's own fit ends from the same start."""
    df = spark.range(0, 1500).select((F.rand(1) + F.col("id") % 3 * 0.7).alias("x"), F.rand(2).alias("y"))
    df = df.unionByName(spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "x double, y double"))
    points = ml._known(df, ["x", "y"])
    assert points.count() == 1500
    jobs = spark.sparkContext.statusTracker()
    starts = ml._start_centres(ml._vectors(points, ["x", "y"]).select("features").cache(), [(k, s) for k in (2, 3, 4) for s in (1, 2)], 2)
    blocks = ml._point_blocks(points, ["x", "y"]).cache()
    spark.sparkContext.setJobGroup("lloyd", "lloyd")
    alone = [ml._lloyd(blocks, [c], [ml._mllib_tol(len(c))], 300)[0] for c in starts]
    each = len(jobs.getJobIdsForGroup("lloyd"))
    spark.sparkContext.setJobGroup("lloyd-all", "lloyd-all")
    together = ml._lloyd(blocks, starts, [ml._mllib_tol(len(c)) for c in starts], 300)
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs.getJobIdsForGroup("lloyd-all")) < each / 2
    for (c, cost), (d, other) in zip(alone, together):
        assert cost == pytest.approx(other) and c == pytest.approx(d)
    for (k, seed), (c, cost) in zip([(k, s) for k in (2, 3, 4) for s in (1, 2)], together):
        model = ml.KMeans(k=k, seed=seed, maxIter=300, tol=ml._mllib_tol(k), solver="block").fit(ml._vectors(points, ["x", "y"]).select("features"))
        assert np.array(model.clusterCenters()) == pytest.approx(c, rel=1e-6) and model.summary.trainingCost == pytest.approx(cost, rel=1e-6)


def test_all_starts_share_their_jobs_and_are_mllibs_own(spark):
    """k-means|| for many (k, seed) runs as many jobs as for one, and gives the centres of MLlib's fit; also for fewer distinct points than k."""
    df = spark.range(0, 6000, 1, 3).select((F.rand(5) + F.col("id") % 4).alias("x"), F.rand(6).alias("y"), (F.col("id") % 3).cast("double").alias("z"))
    few = spark.range(0, 40, 1, 2).select((F.col("id") % 3).cast("double").alias("x"), F.lit(1.0).alias("y"))
    specs = [(k, s) for k in (2, 3, 8) for s in (42, 43, 51)]
    jobs = spark.sparkContext.statusTracker()
    for points in (df, few):
        vec = ml._vectors(points, points.columns).select("features").cache()
        spark.sparkContext.setJobGroup(f"one-{len(points.columns)}", "one start")
        ml._start_centres(vec, specs[:1], 2)
        spark.sparkContext.setJobGroup(f"all-{len(points.columns)}", "all starts")
        starts = ml._start_centres(vec, specs, 2)
        spark.sparkContext.setJobGroup("", "")
        one, both = (len(jobs.getJobIdsForGroup(f"{g}-{len(points.columns)}")) for g in ("one", "all"))
        assert both <= one + 2
        for (k, seed), c in zip(specs, starts):
            own = np.array(ml.KMeans(k=k, seed=seed, maxIter=0, solver="block").fit(vec).clusterCenters())
            assert own.shape == c.shape and own == pytest.approx(c, rel=1e-9, abs=1e-12)
        vec.unpersist()


@pytest.mark.parametrize("kind", ["continuous", "few values", "one point"])
def test_leaves_give_the_sums_of_all_points(kind):
    random = np.random.default_rng(3)
    x = random.normal(size=(3, 20011))
    if kind == "few values":
        x = np.vstack([random.integers(0, 5, 20011), random.integers(0, 9, 20011) / 4, x[0]])
    if kind == "one point":
        x = np.ones_like(x)
    blocks = list(ml._blocks(x))
    assert all(len(b) > 2 for b in blocks) and sum(b[0] for b in blocks) == pytest.approx((x * x).sum())
    fits = [random.permutation(x.T)[:k] + (0 if k % 2 else 0.25) for k in (1, 2, 3, 5, 8, 20)]
    if kind == "one point":
        fits = [c + random.integers(-1, 2, c.shape) for c in fits]
    for c, got in zip(fits, [sum(g) for g in zip(*[ml._block_sums(fits, b) for b in blocks])]):
        want, _ = ml._sums(c[None], np.vstack([x, np.ones(x.shape[1])]))
        assert got[:, -1].tolist() == want[0][:, -1].tolist() and got == pytest.approx(want[0], abs=1e-8)


def test_equal_points_are_dealt_over_all_parts():
    x = np.hstack([np.ones((2, 900)), np.random.default_rng(1).normal(size=(2, 100))])
    sizes: dict[int, int] = {}
    for part, m in ml._dealt(x, ml._regions(x, 10)):
        sizes[part] = sizes.get(part, 0) + m.shape[1]
    assert sum(sizes.values()) == 1000 and set(sizes) <= set(range(10)) and max(sizes.values()) <= 200


def test_one_copy_of_the_points_is_kept(spark, monkeypatch):
    """Neither costs nor vectors of the rows are kept for a search, whatever the number of fits."""
    kept, own, manager = [], ml._pass, spark.sparkContext._jsc.sc()
    df = spark.range(0, 60000, 1, 2).select(F.rand(1).alias("x"), F.rand(2).alias("y"))
    before = {i.id() for i in manager.getRDDStorageInfo()}

    def watched(blocks, fits):
        got = own(blocks, fits)
        kept.append(sum(i.memSize() + i.diskSize() for i in manager.getRDDStorageInfo() if i.id() not in before))
        return got
    monkeypatch.setattr(ml, "_pass", watched)
    _, assigned, _ = ml.kmeans_best(df, ["x", "y"], 3, n_init=10)
    assert assigned.groupBy("cluster").count().count() == 3
    assert 60000 * 2 * 8 <= max(kept) <= 60000 * 2 * 8 * 1.6
    assert not {i.id() for i in manager.getRDDStorageInfo()} - before


def test_a_point_goes_to_the_first_of_equal_centres():
    block = np.array([[0.0, 1.0, 2.0], [1.0, 1.0, 1.0]])
    sums, cost = ml._sums(np.array([[[1.0], [1.0]], [[0.0], [2.0]]]), block)
    assert sums.tolist() == [[[3.0, 3.0], [0.0, 0.0]], [[1.0, 2.0], [2.0, 1.0]]] and cost.tolist() == [2.0, 1.0]


def test_tasks_of_top_categories_follow_the_rows_not_the_session(spark, monkeypatch):
    """With one shuffle partition in the session the orders are still grouped in as many tasks as the rows ask for."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    whole = T.top_categories(spark, SF001).collect()
    monkeypatch.setattr(T.fanout, "ROWS_PER_TASK", 1000)
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        out = T.top_categories(spark, SF001)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = spark.read.parquet(f"{SF001}/lineitem.parquet").count() // 1000 + 1
    assert parts > 1 and f", {parts}), REPARTITION_BY_NUM" in plan
    assert [(r.category, r.orders, r.items_sold, r.avg_rating) for r in rows] == [(r.category, r.orders, r.items_sold, r.avg_rating) for r in whole]
    assert [r.revenue for r in rows] == pytest.approx([r.revenue for r in whole], abs=0.011)


def test_review_fanout_arithmetic_equals_real_join(spark):
    """Items x reviews: counting the fan-out arithmetically equals joining the rows."""
    t = T._t(spark, SF001)
    fast = T._items_summary(T.categorized_items(spark, t), ["category"], with_orders=True)
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    p = t.part.select("p_partkey", "p_type")
    tr = T.type_translation(spark)
    ev = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("r_order"), F.col("value").alias("score"))
    naive = (l.join(p, l.l_partkey == p.p_partkey).join(tr, F.col("p_type") == tr.t_type, "left")
             .join(ev, F.col("l_orderkey") == ev.r_order, "left")
             .groupBy(F.coalesce("t_name", "p_type", F.lit("unknown")).alias("category"))
             .agg(F.countDistinct("l_orderkey").alias("orders"), F.count("l_linenumber").alias("items_sold"),
                  F.sum("l_extendedprice").alias("revenue"), F.avg("score").alias("avg_rating")))
    a = {r.category: r for r in fast.collect()}
    b = {r.category: r for r in naive.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k].orders, a[k].items_sold) == (b[k].orders, b[k].items_sold)
        assert a[k].revenue == pytest.approx(b[k].revenue, abs=0.006)
        if b[k].avg_rating is None:
            assert a[k].avg_rating is None
        else:
            assert a[k].avg_rating == pytest.approx(b[k].avg_rating, abs=0.006)

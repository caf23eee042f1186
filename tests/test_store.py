"""The persisted store: replaced as one unit, counted on the write, co-partitioned by key."""

import os
import re

import pytest
from pyspark.sql import functions as F

from quarry.plans import ecommerce
from quarry.sources import etl
from quarry.sources.store import VersionedStore, manifest, replace_store, versions
from quarry.sources.tables import TableSet, open_store
from tests.conftest import SF001


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_load_that_fails_midway_leaves_the_old_version(spark, tmp_path):
    dst = str(tmp_path / "store")
    replace_store(spark, {"a": spark.range(5), "b": spark.range(7)}, dst)

    def broken(s):
        return s.range(3).select(F.raise_error(F.lit("disk on fire")).cast("long").alias("id"))
    with pytest.raises(Exception, match="disk on fire"):
        replace_store(spark, {"a": spark.range(50), "b": broken}, dst)
    store = open_store(spark, dst, ["a", "b"])
    assert (store["a"].count(), store["b"].count()) == (5, 7) and versions(spark, dst) == [1]
    # the next load takes a number above that of the failed one
    replace_store(spark, {"a": spark.range(50), "c": spark.range(2)}, dst)
    assert versions(spark, dst) == [1, 3]
    assert open_store(spark, dst, ["a", "c"])["a"].count() == 50
    with pytest.raises(FileNotFoundError, match="'b'"):
        open_store(spark, dst, ["a", "b"])
    # a reader of the old version keeps it
    assert store["a"].count() == 5 and VersionedStore(spark, dst, 1)["b"].count() == 7
    with pytest.raises(FileNotFoundError):
        VersionedStore(spark, dst, 2)


def test_rows_are_counted_on_the_write(spark, tmp_path):
    dst = str(tmp_path / "store")
    reads = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            reads.add(len(b))
            yield b
    source = spark.range(0, 1000, 1, 4).mapInPandas(touch, "id long")
    empty = spark.createDataFrame([], "id long, s string")
    audit = replace_store(spark, {"t": source, "empty": empty, "none": spark.range(9).filter("id > 99"),
                                    "parts": spark.range(10).withColumn("g", F.col("id") % 3)}, dst, partition_by={"parts": ["g"]})
    assert {r.table: r.row_count for r in audit.collect()} == {"t": 1000, "empty": 0, "none": 0, "parts": 10}
    assert reads.value == 1000
    store = open_store(spark, dst, ["t", "empty", "none", "parts"])
    assert store["empty"].dtypes == [("id", "bigint"), ("s", "string")] and store["empty"].count() == 0
    assert sorted(r["id"] for r in store["parts"].filter("g = 1").collect()) == [1, 4, 7]
    assert {tuple(r) for r in etl.audit(store).collect()} == {tuple(r) for r in audit.collect()} == {tuple(r) for r in store.audit().collect()}
    assert not [f for f in os.listdir(dst) if f.startswith(".manifest") and not f.endswith(".crc")]
    assert manifest(spark, dst)["tables"]["t"]["row_count"] == 1000
    assert manifest(spark, str(tmp_path / "nowhere")) is None
    with pytest.raises(ValueError, match="versioned"):
        etl.load_tables(spark, {"t": spark.range(1)}, dst)
    flat = etl.load_tables(spark, {"t": spark.range(4), "none": spark.range(0)}, str(tmp_path / "flat"))
    assert sorted(map(tuple, flat.collect())) == [("none", 0), ("t", 4)]
    with pytest.raises(KeyError):
        replace_store(spark, {"t": source}, dst, clustered={"u": ("id", 4)})


def test_joins_of_co_partitioned_tables_need_no_shuffle(spark, tmp_path):
    dst, t = str(tmp_path / "store"), TableSet(spark, SF001)
    orders = t.orders.withColumn("note", F.when(F.col("o_orderkey") % 2 == 0, F.lit("it's")))
    replace_store(spark, {"orders": orders, "lineitem": t.lineitem, "part": t.part}, dst,
                    clustered={"orders": ("o_orderkey", 8), "lineitem": ("l_orderkey", 8)})
    store = open_store(spark, dst, ["orders", "lineitem", "part"])
    assert sorted(store["orders"].collect()) == sorted(orders.collect())

    def revenue(s):
        return (s["orders"].join(s["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
                .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("m")))
    confs = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for c in confs:
        spark.conf.set(c, "-1")
    try:
        plain, clustered = revenue({"orders": orders, "lineitem": t.lineitem}), revenue(store)
        assert sorted(clustered.collect()) == sorted(plain.collect())
        assert "Exchange" in _plan(plain)
        assert "SortMergeJoin" in _plan(clustered) and "Exchange" not in _plan(clustered)
        # through a second session's catalogue as well: the tables are found by the manifest alone
        again = open_store(spark.newSession(), dst, ["orders"])
        assert again["orders"].count() == orders.count()
    finally:
        for c in confs:
            spark.conf.unset(c)


def test_named_query_over_a_clustered_store_joins_in_place(spark, tmp_path):
    """The shop's queries over order tables clustered by the order: the same rows, and lines and payments
    stay where they lie (orders that were joined with customers first come to the payments)."""
    t, dst = TableSet(spark, SF001), str(tmp_path / "store")
    orders = t.orders.select(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
                             F.lit("delivered").alias("order_status"), F.col("o_orderdate").cast("timestamp_ntz").alias("order_purchase_timestamp"))
    items = t.lineitem.select(F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
                              F.col("l_partkey").cast("string").alias("product_id"), F.round("l_extendedprice", 2).alias("price"))
    payments = items.select("order_id", F.lit("card").alias("payment_type"), F.lit(1).alias("payment_installments"), F.col("price").alias("payment_value"))
    customers = t.customer.select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_custkey").cast("string").alias("customer_unique_id"),
                                  F.lit("SP").alias("customer_state"))
    tables = {"orders": orders, "order_items": items, "order_payments": payments, "customers": customers}
    replace_store(spark, tables, dst, clustered={n: ("order_id", 8) for n in ("orders", "order_items", "order_payments")})
    store = open_store(spark, dst, list(tables))
    confs = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for c in confs:
        spark.conf.set(c, "-1")
    try:
        for query, shuffles in ((ecommerce.kpi_summary, 0), (ecommerce.top_customers_by_ltv, 1)):
            a, b = query(tables), query(store)
            assert a.collect() == b.collect()
            by_order = r"Exchange hashpartitioning\(order_id#\d+, \d+\)"
            final = [_plan(x).split("== Initial Plan ==")[0] for x in (a, b)]
            assert len(re.findall(by_order, final[0])) > len(re.findall(by_order, final[1])) == shuffles
    finally:
        for c in confs:
            spark.conf.unset(c)

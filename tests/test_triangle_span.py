import datetime

from quarry.plans.testdata import QUERIES


def test_orders_past_the_listed_months_keep_their_cells(spark, tmp_path):
    day = datetime.date
    orders = [(1, 1, "F", day(1995, 1, 5)), (2, 1, "F", day(2003, 3, 5)), (3, 2, "F", day(1996, 2, 1))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1,), (2,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    rows = QUERIES["retention_triangle"](spark, str(tmp_path)).collect()
    assert len(rows) == 2 and len(rows[0]) == 100
    assert rows[0]["0"] == rows[0]["98"] == 100.0

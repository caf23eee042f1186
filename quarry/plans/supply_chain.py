"""Supply-chain queries (Q22-Q29) on the reference schema: ``orders`` (one row per order item)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import explorer, groups, ranking, rfm, selection
from quarry.session import written


def _late():
    return F.col("late_delivery_risk") == 1


REAL, SCHED = "days_for_shipping_real", "days_for_shipment_scheduled"


def order_date(text_col: str = "order_date_text"):
    """'M/D/YYYY HH:MM' text, unpadded -> DATE."""
    return F.to_date(F.to_timestamp(F.col(text_col), "M/d/yyyy H:mm"))


def late_shipment_by_mode(tables) -> DataFrame:
    return groups.group_profile(tables["orders"], ["shipping_mode"], [
        F.sum(X.flag(_late())).cast("long").alias("late_orders"), X.rate_pct(_late(), 1).alias("late_pct"),
        X.sql_round(F.avg(F.col(REAL) - F.col(SCHED)), 2).alias("avg_delay_days")],
        count_name="total_orders", order=[F.col("late_pct").desc(), F.col("shipping_mode")])


def late_shipment_by_region(tables) -> DataFrame:
    return groups.group_profile(
        tables["orders"], [F.col("order_region").alias("region"), "shipping_mode"],
        [X.rate_pct(_late(), 1).alias("late_pct")], count_name="total_orders", min_count=50,
        order=[F.col("late_pct").desc(), F.col("region"), F.col("shipping_mode")])


def reorder_risk_by_product(tables) -> DataFrame:
    prod = tables["orders"].groupBy("product_name", "category_name").agg(
        F.count(F.lit(1)).alias("order_count"), F.avg("order_item_quantity").alias("_q"),
        F.avg(REAL).alias("_d"))
    prod = prod.filter(F.col("order_count") >= 30).select(
        "product_name", "category_name", "order_count", X.sql_round("_q", 2).alias("avg_order_quantity"),
        X.sql_round("_d", 2).alias("avg_lead_time_days"),
        X.sql_round(F.col("_q") * F.col("_d"), 2).alias("replenishment_burden"))
    order = [F.col("replenishment_burden").desc_nulls_last(), F.col("product_name").asc_nulls_last(),
             F.col("category_name").asc_nulls_last()]
    q = selection.ntiles(written(prod, "risk-products"), 4, {"risk_quartile": [
        ("replenishment_burden", "desc"), ("product_name", "asc"), ("category_name", "asc")]})
    return ranking.top_k(q, order, 25)


def market_reliability(tables) -> DataFrame:
    o = tables["orders"]
    per_region = o.groupBy("market", F.col("order_region").alias("region")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(X.flag(_late())).alias("_late"),
        F.sum("order_item_profit_ratio").alias("_pr"), F.count("order_item_profit_ratio").alias("_prn"))
    out = per_region.groupBy("market").agg(
        F.sum("_n").cast("long").alias("total_orders"),
        X.sql_round(F.lit(100.0) - F.sum("_late") * F.lit(100.0) / F.sum("_n"), 1).alias("on_time_pct"),
        X.sql_round(F.sum("_pr") / F.sum("_prn"), 3).alias("avg_profit_ratio"),
        F.count("region").alias("regions_served"))
    return out.orderBy(F.col("on_time_pct").desc_nulls_last(), F.col("market"))


def rfm_analysis(tables) -> DataFrame:
    r = rfm.customer_rfm(tables["orders"], "order_customer_id", order_date(), "order_item_total")
    return r.orderBy(F.col("rfm_score").desc(), F.col("customer_id"))


def rfm_segment_summary(tables) -> DataFrame:
    r = rfm.customer_rfm(tables["orders"], "order_customer_id", order_date(), "order_item_total")
    return rfm.rfm_summary(r)


def category_options(tables) -> DataFrame:
    return groups.distinct_options(tables["orders"], "category_name", "category")


def filtered_late_shipments(tables, category: str | None = None) -> DataFrame:
    o = tables["orders"].filter(_late())
    cols = ["order_id", F.col("category_name").alias("category"), F.col("order_region").alias("region"),
            "shipping_mode", F.col(REAL).alias("days_actual"), F.col(SCHED).alias("days_scheduled"),
            "late_delivery_risk", "sales"]
    return explorer.filtered_explorer(o, [("category_name", "=", category)],
                                      [(F.col(REAL) - F.col(SCHED)).desc_nulls_last(), F.col("order_id")],
                                      200, cols)


QUERIES = {f.__name__: f for f in (
    late_shipment_by_mode, late_shipment_by_region, reorder_risk_by_product, market_reliability,
    rfm_analysis, rfm_segment_summary, category_options, filtered_late_shipments)}

"""E-commerce star-schema queries (Q38-Q48, M8) on the reference schema.

``customer_id`` is per order; ``customer_unique_id`` is the person, so every
per-person measure joins through ``customers`` first (except
``monthly_revenue_growth.unique_customers``, which counts ``customer_id`` as
the reference does). The review join keeps its fan-out by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import explorer, fanout, groups, growth, ranking


def _is_delivered():
    return F.col("order_status") == "delivered"


def _delivered(tables) -> DataFrame:
    return tables["orders"].filter(_is_delivered())


def _with_person(tables, orders: DataFrame) -> DataFrame:
    c = tables["customers"].select("customer_id", "customer_unique_id", "customer_state")
    return orders.join(c, "customer_id")


def kpi_summary(tables) -> DataFrame:
    pay = tables["order_payments"].groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))
    o = _delivered(tables).select("order_id", "customer_id").join(pay, "order_id")
    return groups.kpi_summary(_with_person(tables, o), "order_id", "customer_unique_id", "payment_value")


def monthly_revenue_growth(tables, from_month: str | None = None) -> DataFrame:
    o = _delivered(tables).select("order_id", "customer_id", "order_purchase_timestamp")
    pay = tables["order_payments"].select("order_id", "payment_value")
    return growth.period_growth(o.join(pay, "order_id"), "order_purchase_timestamp", "payment_value",
                                "order_id", "customer_id", from_period=from_month)


def _categorized_items(tables, dedupe_reviews: bool = False, parts: int | None = None) -> DataFrame:
    items = tables["order_items"].select("order_id", "order_item_id", "product_id", "price")
    p = tables["products"].select("product_id", "product_category_name")
    t = tables["category_translation"]  # lookup: AQE broadcasts it from its measured size
    j = (items.join(p, "product_id")
         .join(t, "product_category_name", "left")
         .withColumn("category_or_null", F.coalesce("product_category_name_english", "product_category_name"))
         .withColumn("category", F.coalesce("product_category_name_english", "product_category_name",
                                            F.lit("unknown"))))
    return fanout.review_weights(j, tables["order_reviews"], "order_id", "order_id", "review_score",
                                 dedupe=dedupe_reviews, parts=parts)


def top_categories(tables, dedupe_reviews: bool = False) -> DataFrame:
    w = _categorized_items(tables, dedupe_reviews, fanout.task_parts(tables["order_items"]))
    out = fanout.fanout_summary(w, ["category"], "order_id", "order_item_id", "price")
    return ranking.top_k(out, [F.col("revenue").desc_nulls_last(), F.col("category")], 20)


def _fulfilled(tables) -> DataFrame:
    return _delivered(tables).filter(F.col("order_delivered_customer_date").isNotNull())


def order_fulfillment_summary(tables) -> DataFrame:
    o = _fulfilled(tables)
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return o.agg(
        X.sql_round(F.avg(X.day_diff("order_purchase_timestamp", "order_delivered_customer_date")), 2)
        .alias("avg_delivery_days"),
        X.sql_round(F.avg(X.day_diff("order_delivered_customer_date", "order_estimated_delivery_date")), 2)
        .alias("avg_days_before_estimate"),
        X.rate_pct(late, 2).alias("late_pct"))


def regional_fulfillment(tables) -> DataFrame:
    o = _with_person(tables, _fulfilled(tables))
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return groups.group_profile(
        o, [F.col("customer_state").alias("state")],
        [X.sql_round(F.avg(X.day_diff("order_purchase_timestamp", "order_delivered_customer_date")), 2)
         .alias("avg_delivery_days"), X.rate_pct(late, 2).alias("late_pct")],
        count_name="order_count", min_count=30, order=[F.col("late_pct").desc(), F.col("state")])


def repeat_purchase_rate(tables) -> DataFrame:
    o = _with_person(tables, _delivered(tables).select("order_id", "customer_id"))
    return growth.repeat_rate(o, "customer_unique_id", "order_id")


def monthly_cohort_retention(tables) -> DataFrame:
    o = _with_person(tables, _delivered(tables).select("customer_id", "order_purchase_timestamp"))
    return growth.cohort_activity(o, "customer_unique_id", "order_purchase_timestamp")


def cohort_retention_pct(tables) -> DataFrame:
    """M8: the cohort triangle as % of each cohort's month 0 (long form)."""
    return growth.retention_pct(monthly_cohort_retention(tables))


def cohort_retention_triangle(tables) -> DataFrame:
    """M8, wide form: one row per cohort, one column for every month that the purchase dates span
    (their first and last date are read for it)."""
    span = tables["orders"].agg(F.min("order_purchase_timestamp").alias("lo"), F.max("order_purchase_timestamp").alias("hi")).first()
    months = 0 if span["lo"] is None else 12 * (span["hi"].year - span["lo"].year) + span["hi"].month - span["lo"].month + 1
    return growth.retention_triangle(cohort_retention_pct(tables), months)


def top_customers_by_ltv(tables) -> DataFrame:
    o = _with_person(tables, _delivered(tables).select("order_id", "customer_id"))
    pay = tables["order_payments"].groupBy("order_id").agg(F.sum("payment_value").alias("_v"))
    j = o.join(pay, "order_id")
    out = j.groupBy("customer_unique_id", "customer_state").agg(
        F.count("order_id").alias("order_count"), X.sql_round(F.sum("_v"), 2).alias("lifetime_value"))
    return ranking.top_k(out, [F.col("lifetime_value").desc_nulls_last(), F.col("customer_unique_id")], 20)


def payment_type_breakdown(tables) -> DataFrame:
    pay = tables["order_payments"]
    per_order = pay.groupBy("payment_type", "order_id").agg(
        F.sum("payment_value").alias("_v"), F.sum("payment_installments").alias("_i"),
        F.count("payment_installments").alias("_in"))
    out = per_order.groupBy("payment_type").agg(
        F.count("order_id").alias("order_count"), X.sql_round(F.sum("_v"), 2).alias("total_revenue"),
        X.sql_round(F.sum("_i") / F.sum("_in"), 2).alias("avg_installments"))
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("payment_type"))


def category_options(tables) -> DataFrame:
    p = tables["products"].filter(F.col("product_category_name").isNotNull())
    t = tables["category_translation"]
    j = p.join(t, "product_category_name", "left")
    return groups.distinct_options(j, F.coalesce("product_category_name_english", "product_category_name"),
                                   "category")


def filtered_products(tables, category: str | None = None) -> DataFrame:
    w = _categorized_items(tables)
    w = explorer.optional_filter(w, "category_or_null", "=", category)
    out = fanout.fanout_summary(w.withColumn("category", F.col("category_or_null")), ["product_id", "category"],
                                "order_id", "order_item_id", "price", with_orders=False, with_avg_price=False)
    return ranking.top_k(out, [F.col("revenue").desc_nulls_last(), F.col("product_id")], 200)


QUERIES = {f.__name__: f for f in (
    kpi_summary, monthly_revenue_growth, top_categories, order_fulfillment_summary, regional_fulfillment,
    repeat_purchase_rate, monthly_cohort_retention, cohort_retention_pct, cohort_retention_triangle,
    top_customers_by_ltv,
    payment_type_breakdown, category_options, filtered_products)}

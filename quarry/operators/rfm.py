"""Recency / frequency / monetary segmentation with exact global quartiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import sql_round
from quarry.operators.selection import ntiles
from quarry.session import written

# Segment cut points on the summed score (3..12), highest first.
SEGMENTS = [(10, "Champions"), (7, "Loyal"), (4, "At Risk")]
OTHER_SEGMENT = "Lost"


def segment_label(score) -> "F.Column":
    expr = None
    for cut, label in SEGMENTS:
        expr = F.when(score >= cut, F.lit(label)) if expr is None else expr.when(score >= cut, F.lit(label))
    return expr.otherwise(F.lit(OTHER_SEGMENT))


def customer_rfm(df: DataFrame, customer: str, order_date, amount: str, *,
                 tiles: int = 4, digits: int = 2) -> DataFrame:
    """Per customer: recency_days (to the data's latest date), frequency
    (distinct order *dates*), monetary (rounded spend), three quartile scores
    where 4 is best, their sum and a segment label.

    Scale plan: (customer, date) pre-aggregate -> per-customer aggregate ->
    one-row max date (broadcast, size 1) -> written once, one row per customer ->
    the rows at which the three orders are cut, found together (``ntiles``), and
    the scores by comparison to those: customers are neither sorted nor shuffled.
    ``customer`` is the unique tie-break inside each NTILE.
    """
    d = order_date if not isinstance(order_date, str) else F.col(order_date)
    base = df.select(F.col(customer).alias("customer_id"), F.to_date(d).alias("order_date"),
                     F.col(amount).alias("_amt"))
    per_day = base.groupBy("customer_id", "order_date").agg(F.sum("_amt").alias("_amt"))
    cust = per_day.groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        F.count("order_date").alias("frequency"),
        sql_round(F.sum("_amt"), digits).alias("monetary"))
    max_date = cust.agg(F.max("_last").alias("_max_date"))
    cust = (cust.crossJoin(F.broadcast(max_date))
            .withColumn("recency_days", F.datediff("_max_date", "_last").cast("long"))
            .drop("_max_date", "_last"))
    last = ("customer_id", "asc")
    cust = ntiles(written(cust, "rfm-customers"), tiles, {
        "recency_score": [("recency_days", "desc"), last], "frequency_score": [("frequency", "asc"), last],
        "monetary_score": [("monetary", "asc"), last]})
    score = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return cust.select("customer_id", "recency_days", "frequency", "monetary", "recency_score",
                       "frequency_score", "monetary_score", score.alias("rfm_score"),
                       segment_label(score).alias("segment"))


def rfm_summary(rfm: DataFrame, digits: int = 2) -> DataFrame:
    """Segment -> customers, total and average revenue, largest revenue first."""
    return (rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        sql_round(F.sum("monetary"), digits).alias("total_revenue"),
        sql_round(F.avg("monetary"), digits).alias("avg_revenue_per_customer"))
        .orderBy(F.col("total_revenue").desc_nulls_last(), "segment"))

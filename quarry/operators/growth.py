"""Period-over-period growth and customer cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.exprs import half_even_round, month_index, month_start, safe_divide, sql_round


def period_growth(df: DataFrame, ts: str, amount: str, order_key: str, person_key: str, *,
                  from_period=None, digits: int = 2, growth_digits: int = 1) -> DataFrame:
    """Month -> revenue, order_count, unique_customers, prev_month_revenue,
    mom_growth_pct.

    Distinct counts come from a (month, order, person) pre-aggregate and a
    (month, person) aggregate instead of Expand. The ``lag`` window has one
    row per month, a calendar-bounded size. ``from_period`` filters months
    *after* the lag so the first kept month still has its base.
    """
    per_order = df.groupBy(month_start(ts).alias("month"), order_key, person_key).agg(
        F.sum(amount).alias("_amt"))
    per_person = per_order.groupBy("month", person_key).agg(
        F.count(F.col(order_key)).alias("_orders"), F.sum("_amt").alias("_amt"))
    monthly = per_person.groupBy("month").agg(
        sql_round(F.sum("_amt"), digits).alias("revenue"),
        F.sum("_orders").cast("long").alias("order_count"),
        F.count(F.col(person_key)).alias("unique_customers"))
    w = Window.orderBy("month")
    prev = F.lag("revenue").over(w)
    out = (monthly.withColumn("prev_month_revenue", prev)
           .withColumn("mom_growth_pct", sql_round(
               safe_divide(F.col("revenue") - F.col("prev_month_revenue"), "prev_month_revenue")
               * F.lit(100.0), growth_digits)))
    if from_period is not None:
        out = out.filter(F.col("month") >= F.to_date(F.lit(str(from_period))))
    return out.orderBy("month")


def repeat_rate(df: DataFrame, person_key: str, order_key: str, digits: int = 2) -> DataFrame:
    """Persons, persons with more than one distinct order, and their share in %."""
    per_person = (df.select(person_key, order_key).distinct()
                  .groupBy(person_key).agg(F.count(F.col(order_key)).alias("_orders")))
    rep = F.when(F.col("_orders") > 1, F.lit(1)).otherwise(F.lit(0))
    return per_person.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(rep).cast("long").alias("repeat_customers"),
        sql_round(F.sum(rep) * F.lit(100.0) / F.count(F.lit(1)), digits).alias("repeat_purchase_rate_pct"))


def cohort_activity(df: DataFrame, person_key: str, ts: str) -> DataFrame:
    """(cohort_month, month_index) -> active_customers.

    cohort_month is the person's first active month; month_index counts month
    boundaries since then. (person, month) pairs are de-duplicated first, so
    the per-person window sees at most one row per calendar month even for a
    person holding a third of all rows, and the final count needs no DISTINCT.
    """
    pm = df.select(F.col(person_key), month_start(ts).alias("order_month")).distinct()
    pm = pm.withColumn("cohort_month", F.min("order_month").over(Window.partitionBy(person_key)))
    return (pm.groupBy("cohort_month", month_index("cohort_month", "order_month").alias("month_index"))
            .agg(F.count(F.lit(1)).alias("active_customers"))
            .orderBy("cohort_month", "month_index"))


def retention_pct(cohorts: DataFrame, digits: int = 3) -> DataFrame:
    """Cohort triangle in long form as a percent of month 0, rounded half-to-even
    to ``digits`` on the ratio (then x100), like a pandas ``.round``.
    One row per (cohort, index): the per-cohort window is calendar-bounded."""
    size = F.max(F.when(F.col("month_index") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month"))
    return (cohorts.withColumn("_size", size)
            .withColumn("retention_pct",
                        half_even_round(F.col("active_customers") / F.col("_size"), digits) * F.lit(100.0))
            .drop("_size"))


def retention_triangle(retention: DataFrame, months: int, value: str = "retention_pct") -> DataFrame:
    """The long cohort table pivoted wide: one row per cohort, one column per
    month index "0" to str(months - 1). ``months`` is the number of calendar
    months that the dates span, so no index lies beyond it."""
    indexes = list(range(months))
    wide = (retention.groupBy("cohort_month").pivot("month_index", indexes).agg(F.first(value)))
    return wide.select("cohort_month", *[F.col(f"`{i}`") for i in indexes]).orderBy("cohort_month")

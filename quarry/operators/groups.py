"""Grouped profiles, distinct-count summaries and option lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import col, sql_round


def group_profile(df: DataFrame, by: Sequence, aggs: Sequence[Column], *,
                  count_name: str | None = "count", min_count: int | None = None,
                  order: Sequence[Column] | None = None, limit: int | None = None) -> DataFrame:
    """``SELECT by, COUNT(*) AS count_name, aggs FROM df GROUP BY by
    [HAVING COUNT(*) >= min_count] [ORDER BY order] [LIMIT limit]``.

    Partial aggregation runs map-side, so a hot key is reduced before the shuffle.
    """
    cnt = F.count(F.lit(1))
    all_aggs = ([cnt.alias(count_name)] if count_name else []) + list(aggs)
    if min_count is not None and not count_name:
        all_aggs.append(cnt.alias("_having_n"))
    out = df.groupBy(*[col(c) for c in by]).agg(*all_aggs)
    if min_count is not None:
        out = out.filter(F.col(count_name or "_having_n") >= min_count)
        if not count_name:
            out = out.drop("_having_n")
    if order:
        out = out.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    return out


def distinct_options(df: DataFrame, value: Column | str, alias: str, *,
                     drop_null: bool = False, drop_empty: bool = False) -> DataFrame:
    """Sorted distinct values of one expression (a dropdown's option list)."""
    v = col(value).alias(alias)
    out = df.select(v)
    if drop_null or drop_empty:
        out = out.filter(F.col(alias).isNotNull())
    if drop_empty:
        out = out.filter(F.col(alias) != "")
    return out.distinct().orderBy(F.col(alias).asc_nulls_last())


def counted_options(df: DataFrame, value: Column | str, alias: str, *, min_count: int,
                    count_name: str = "count") -> DataFrame:
    """Non-empty values with at least ``min_count`` rows, most frequent first."""
    v = col(value).alias(alias)
    out = (df.select(v).filter(F.col(alias).isNotNull() & (F.col(alias) != ""))
           .groupBy(alias).agg(F.count(F.lit(1)).alias(count_name))
           .filter(F.col(count_name) >= min_count))
    return out.orderBy(F.col(count_name).desc(), F.col(alias).asc())


def order_person_totals(facts: DataFrame, order_key: str, person_key: str,
                        amount: str | None = None) -> DataFrame:
    """One row per (order, person) with the summed amount.

    This is the pre-aggregation that replaces ``COUNT(DISTINCT order)`` +
    ``COUNT(DISTINCT person)`` (Spark's Expand rewrite copies every row once per
    distinct aggregate). When ``facts`` comes from a join on ``order_key`` the
    grouping reuses the join's partitioning — no extra shuffle.
    """
    aggs = [F.sum(amount).alias("_amount")] if amount else [F.count(F.lit(1)).alias("_rows")]
    return facts.groupBy(order_key, person_key).agg(*aggs)


def kpi_summary(facts: DataFrame, order_key: str, person_key: str, amount: str, *,
                digits: int = 2, approx_persons: float | None = None) -> DataFrame:
    """Headline KPIs: distinct orders, distinct persons, revenue, average order value.

    Two map-side-combined aggregations (per order, then per person) followed by a
    one-row global aggregate; no row is copied per distinct count.
    ``approx_persons`` (a relative standard deviation, e.g. 0.01) counts persons
    with HyperLogLog++ over the per-order rows instead: fixed-size sketches,
    no per-person shuffle.
    """
    per_order = order_person_totals(facts, order_key, person_key, amount)
    if approx_persons is not None:
        return per_order.agg(
            F.count(F.col(order_key)).alias("total_orders"),
            F.approx_count_distinct(person_key, approx_persons).alias("total_customers"),
            sql_round(F.sum("_amount"), digits).alias("total_revenue"),
            sql_round(F.sum("_amount") / F.count(F.col(order_key)), digits).alias("avg_order_value"))
    per_person = per_order.groupBy(person_key).agg(
        F.count(F.col(order_key)).alias("_orders"), F.sum("_amount").alias("_amount"))
    return per_person.agg(
        F.sum("_orders").cast("long").alias("total_orders"),
        F.count(F.col(person_key)).alias("total_customers"),
        sql_round(F.sum("_amount"), digits).alias("total_revenue"),
        sql_round(F.sum("_amount") / F.sum("_orders"), digits).alias("avg_order_value"))

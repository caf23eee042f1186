"""One-to-many left joins whose row fan-out must be kept, without multiplying rows.

``items LEFT JOIN reviews ON key`` repeats each item once per review. Summing
over the joined rows equals summing over items with a weight = number of
matching reviews (at least 1), and averaging the review score over the joined
rows equals (sum over items of the per-key score sum) / (sum of per-key score
counts). So the reviews are first reduced to one row per key (map-side
combined), then joined — a key with a third of all reviews adds one row, not
a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import sql_round


# Exact sums of scores: wide enough for any score of ten decimals; a larger value raises.
SCORE_TYPE = "decimal(24,10)"

ROWS_PER_TASK = 200_000   # items of one join task, where their orders are grouped in the same task


def task_parts(items: DataFrame) -> int:
    """Tasks of ``ROWS_PER_TASK`` rows for a table (its rows are counted)."""
    return items.count() // ROWS_PER_TASK + 1


def review_weights(items: DataFrame, reviews: DataFrame, item_key: str, review_key: str,
                   score: str, *, dedupe: bool = False, parts: int | None = None) -> DataFrame:
    """``items`` + ``_fan`` (copies the join would make), ``_rcnt`` / ``_rsum``
    (non-null score count and exact decimal sum of the matched reviews).
    ``dedupe=True`` counts every item once (the corrected, non-faithful form). ``parts``
    (see ``task_parts``) fixes the number of join tasks, so that what one holds does not
    grow with the tables, whatever the session's number of shuffle partitions."""
    per_key = reviews.groupBy(F.col(review_key).alias("_rk")).agg(
        F.count(F.lit(1)).alias("_rrows"), F.count(score).alias("_rcnt"),
        F.sum(F.col(score).cast(SCORE_TYPE)).alias("_rsum"))
    if parts:
        items, per_key = items.repartition(parts, item_key), per_key.repartition(parts, "_rk")
    j = items.join(per_key, items[item_key] == per_key["_rk"], "left").drop("_rk")
    fan = F.lit(1) if dedupe else F.greatest(F.coalesce(F.col("_rrows"), F.lit(0)), F.lit(1))
    return (j.withColumn("_fan", fan.cast("long"))
            .withColumn("_rcnt", F.coalesce(F.col("_rcnt"), F.lit(0)))
            .withColumn("_rsum", F.coalesce(F.col("_rsum"), F.lit(0).cast(SCORE_TYPE)))
            .drop("_rrows"))


def fanout_summary(weighted: DataFrame, by: Sequence[str], order_key: str, item_col: str, price_col: str, *,
                   with_orders: bool = True, with_avg_price: bool = True, digits: int = 2) -> DataFrame:
    """Per group over the (virtual) joined rows: distinct orders, items counted,
    revenue, average item price and average review score.
    Distinct orders come from a (group, order) pre-aggregate, not Expand."""
    fan = F.col("_fan")
    keys = [*by, order_key] if with_orders else list(by)
    lvl1 = weighted.groupBy(*keys).agg(
        F.sum(F.when(F.col(item_col).isNotNull(), fan).otherwise(0)).alias("_items"),
        F.sum(F.col(price_col) * fan).alias("_rev"),
        F.sum(F.when(F.col(price_col).isNotNull(), fan).otherwise(0)).alias("_pn"),
        F.sum("_rcnt").alias("_rc"), F.sum("_rsum").alias("_rs"))
    aggs = []
    if with_orders:
        aggs.append(F.count(F.col(order_key)).alias("orders"))
    aggs += [F.sum("_items").cast("long").alias("items_sold"), sql_round(F.sum("_rev"), digits).alias("revenue")]
    if with_avg_price:
        aggs.append(sql_round(F.sum("_rev") / F.sum("_pn"), digits).alias("avg_item_price"))
    avg_rating = (F.sum("_rs") / F.nullif(F.sum("_rc"), F.lit(0)).cast("decimal(18,0)"))
    aggs.append(F.round(avg_rating, digits).cast("double").alias("avg_rating"))
    return lvl1.groupBy(*by).agg(*aggs)

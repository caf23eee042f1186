"""Per-group distributions and outliers against the group median."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import sql_round
from quarry.operators.selection import group_quantiles


def distribution_by_group(df: DataFrame, by: Sequence[str], value: str, *,
                          min_count: int | None = None, digits: int | None = 2,
                          exact: bool = True, count_name: str = "count",
                          decimal_scale: int | None = None) -> DataFrame:
    """count, mean, median, q1, q3 and range (max - min) of ``value`` per group.

    ``exact=True`` finds the quantiles by sketches and counts, in the scan that the
    other statistics take and one more (no group held in one task); ``exact=False`` uses ``percentile_approx`` (bounded sketch).
    NULL values are ignored by every statistic but ``count``. ``decimal_scale``
    makes the quantile interpolation exact decimal (see ``group_quantiles``).
    """
    by = list(by)
    r = (lambda c: sql_round(c, digits)) if digits is not None else (lambda c: c)
    v = F.col(value)
    basic = [F.count(F.lit(1)).alias(count_name), F.avg(v).alias("_avg"), (F.max(v) - F.min(v)).alias("_range")]
    if exact:
        out = group_quantiles(df, by, value, {"_med": 0.5, "_q1": 0.25, "_q3": 0.75}, decimal_scale=decimal_scale, aggs=basic)
    else:
        out = df.groupBy(*by).agg(
            *basic, F.percentile_approx(v, 0.5).alias("_med"), F.percentile_approx(v, 0.25).alias("_q1"),
            F.percentile_approx(v, 0.75).alias("_q3"))
    if min_count is not None:
        out = out.filter(F.col(count_name) >= min_count)
    if decimal_scale is not None and digits is not None:  # exact decimal: both engines agree
        rq = lambda c: F.round(F.col(c), digits).cast("double")
    else:
        rq = lambda c: r(F.col(c).cast("double"))
    return out.select(*by, count_name, r(F.col("_avg")).alias("avg_value"),
                      rq("_med").alias("median_value"), rq("_q1").alias("q1"),
                      rq("_q3").alias("q3"), r(F.col("_range")).alias("value_range"))


def group_outliers(df: DataFrame, by: Sequence[str], value: str, *, factor: float = 10.0,
                   min_count: int = 20, ratio_digits: int = 1) -> DataFrame:
    """Rows whose ``value`` exceeds ``factor`` x their group's median
    (groups with at least ``min_count`` rows), with ``median_value`` and
    ``x_median`` = value / median. The per-group statistics side is one row per
    group; adaptive execution broadcasts it where its measured bytes allow, and
    splits hot groups of the join where they don't. Rows of a NULL group are not
    compared.
    """
    by = list(by)
    stats = (group_quantiles(df, by, value, {"median_value": 0.5}, aggs=[F.count(F.lit(1)).alias("_n")])
             .filter(F.col("_n") >= min_count).drop("_n"))
    joined = df.join(stats, on=by, how="inner")
    return (joined.filter(F.col(value) > F.col("median_value") * F.lit(factor))
            .withColumn("x_median", sql_round(F.col(value) / F.col("median_value"), ratio_digits)))

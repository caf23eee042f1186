"""Pearson correlations in one pass, wide and long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import safe_corr, sql_round


def correlations(df: DataFrame, pairs: dict[str, tuple[str, str]], digits: int | None = 3) -> DataFrame:
    """One row: ``name -> corr(x, y)`` for every pair, all in a single aggregate
    (algebraic, combined map-side). Constant columns give NULL, not an error."""
    aggs = []
    for name, (x, y) in pairs.items():
        c = safe_corr(x, y)
        aggs.append((sql_round(c, digits) if digits is not None else c).alias(name))
    return df.agg(*aggs)


def correlations_long(wide: DataFrame, name_col: str = "attribute", value_col: str = "corr",
                      strip_suffix: str = "_corr") -> DataFrame:
    """Wide one-row result -> (attribute, corr) rows, suffix stripped, ascending.

    ``unpivot`` is an executor-side expand; nothing is transposed on the driver.
    """
    long = wide.unpivot(ids=[], values=wide.columns, variableColumnName=name_col,
                        valueColumnName=value_col)
    if strip_suffix:
        long = long.withColumn(name_col, F.regexp_replace(name_col, strip_suffix + "$", ""))
    return long.orderBy(F.col(value_col).asc_nulls_last(), F.col(name_col))

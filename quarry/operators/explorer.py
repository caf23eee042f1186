"""Optional-parameter explorers: each filter applies only when its value is given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import col

_OPS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def optional_filter(df: DataFrame, column, op: str, value) -> DataFrame:
    """``WHERE ($p IS NULL OR column op $p)``: no filter at all when ``value`` is None."""
    if value is None:
        return df
    return df.filter(_OPS[op](col(column), F.lit(value)))


def filtered_explorer(df: DataFrame, filters: Sequence[tuple], order: Sequence[Column],
                      limit: int, columns: Sequence | None = None) -> DataFrame:
    """Apply the optional filters (pushed to the scan by Catalyst), sort and keep
    the first ``limit`` rows. ``order`` may use columns that are not returned."""
    out = df
    for column, op, value in filters:
        out = optional_filter(out, column, op, value)
    out = out.orderBy(*order).limit(limit)
    if columns is not None:
        out = out.select(*[col(c) for c in columns])
    return out

"""Table profiles, value counts, melt and pivot — all executor-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import sql_round


def table_profile(df: DataFrame, with_types: bool = True) -> DataFrame:
    """(column_name, dtype, non_null_count, row_count) for every column, from one
    aggregate. ``dtype`` is the Spark SQL type name, taken from the schema at
    plan time (no data is read for it)."""
    aggs = [F.count(F.col(c)).alias(c) for c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    long = wide.unpivot(ids=["_rows"], values=df.columns, variableColumnName="column_name",
                        valueColumnName="non_null_count")
    cols = ["column_name", "non_null_count", F.col("_rows").alias("row_count")]
    if with_types:
        types = F.create_map(*[x for name, t in df.dtypes for x in (F.lit(name), F.lit(t))])
        cols.insert(1, types[F.col("column_name")].alias("dtype"))
    return long.select(*cols)


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_share) for columns with at least one null."""
    prof = table_profile(df, with_types=False)
    nulls = F.col("row_count") - F.col("non_null_count")
    return (prof.withColumn("null_count", nulls)
            .withColumn("null_share", sql_round(nulls / F.col("row_count"), 4))
            .filter(F.col("null_count") > 0)
            .select("column_name", "null_count", "null_share")
            .orderBy(F.col("null_count").desc(), "column_name"))


def sentinel_share(df: DataFrame, column: str, sentinel=0, digits: int = 4) -> DataFrame:
    """How many rows carry the sentinel value (e.g. rating 0 = unrated), and their share."""
    hit = F.when(F.col(column) == F.lit(sentinel), F.lit(1)).otherwise(F.lit(0))
    return df.agg(F.sum(hit).cast("long").alias("sentinel_count"),
                  sql_round(F.sum(hit) / F.count(F.lit(1)), digits).alias("sentinel_share"))


def value_counts(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Frequency of each value, most frequent first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.col(count_name).desc(), F.col(column).asc_nulls_last()))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str,
         value_name: str) -> DataFrame:
    """Wide -> long (pandas ``melt``), via Spark ``unpivot``."""
    return df.unpivot(ids=list(ids), values=list(values), variableColumnName=var_name,
                      valueColumnName=value_name)


def pivot_wide(df: DataFrame, row: Sequence[str] | str, column: str, value: str,
               values: Sequence) -> DataFrame:
    """Long -> wide without aggregation (one value per cell). The column
    values are listed up front, so Spark runs no extra job to discover them."""
    rows = [row] if isinstance(row, str) else list(row)
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.first(value))

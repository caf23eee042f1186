"""Top-k overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """``ORDER BY order LIMIT k`` — planned as TakeOrderedAndProject: every
    partition keeps its own k best rows, only k x #partitions rows move."""
    return df.orderBy(*order).limit(k)


def topk_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
                   rank_col: str = "rank_in_group", keep_rank: bool = False) -> DataFrame:
    """Rows with ``RANK() OVER (PARTITION BY by ORDER BY order) <= k``; ties are kept.

    Spark plans a partial ``WindowGroupLimit`` before the shuffle, so each map
    task forwards only its own top-k (plus ties) per group.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    out = df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= k)
    return out if keep_rank else out.drop(rank_col)


def kept_values(df: DataFrame, by: Sequence[str], values: Sequence[str], order: Sequence[Column], k: int,
                weight: str | None = None) -> DataFrame:
    """The (group, value) pairs whose rows have ``RANK() <= k``, with that rank as ``rank_in_group``.

    ``values`` are the columns that ``order`` sorts by. Rows are counted by group and value first (a
    combining aggregate; ``weight`` names a column of counts), and the cut falls where the running count
    reaches k. A row's rank is one more than the rows above its value, so k values a group are enough:
    the window sees values instead of rows, behind a partial ``WindowGroupLimit``.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(*by, *values).agg(n.alias("_n"))
    w = Window.partitionBy(*by).orderBy(*order)
    some = counts.withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= k)
    above = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (some.withColumn("rank_in_group", above + 1).filter(F.col("rank_in_group") <= k)
            .select(*by, *values, "rank_in_group"))


def topk_by_cut(df: DataFrame, by: Sequence[str], values: Sequence[str], order: Sequence[Column], k: int,
                keep_rank: bool = False) -> DataFrame:
    """The rows of ``topk_per_group`` by one join with ``kept_values``: no row of ``df`` is sorted, and a
    hot group or a value that most rows share adds one count. ``df`` is evaluated twice. NULL groups and
    values are groups and values as in a window."""
    kept = kept_values(df, by, values, order, k)
    keys = [*by, *values]
    kept = kept.select(*[F.col(c).alias(f"_kept_{i}") for i, c in enumerate(keys)], "rank_in_group")
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_kept_{i}"))
    if keep_rank:
        return df.join(kept, same).drop(*[f"_kept_{i}" for i in range(len(keys))])
    return df.join(kept.drop("rank_in_group"), same, "left_semi")

"""Exact row positions in a sort order, computed without a single-partition stage.

Spark runs ``ntile()`` / ``row_number()`` over a window without ``PARTITION BY``
in one task, and a window or ``percentile`` aggregate over one hot group puts
that whole group in one task. ``with_positions`` gives the same exact answer
with the work spread over all partitions:

1. range-partition on (group keys, sort keys) — the sort keys must make the
   order total, so a hot group or a hot value is split across partitions by
   the tie-break columns;
2. sort within partitions and number rows locally
   (``monotonically_increasing_id`` = partition index << 33 | local index);
3. write the numbered rows to the shared folder so a lost executor cannot
   re-sample different range bounds and renumber rows;
4. count rows per (partition, group) — at most #groups + #partitions rows —
   and turn the counts into offsets with a prefix sum;
5. join the offsets back (a broadcast of one row per partition without groups,
   left to Spark with groups): position = offset + local index within the group.

Where only quantiles or tiles are asked for, ``operators.selection`` finds them
without sorting or writing the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import selection
from quarry.session import written

_LOCAL_BITS = 33


def _num_partitions(df: DataFrame, requested: int | None) -> int:
    """Range partitions: as requested, else the session's shuffle partitions (or
    the default parallelism where that setting is not a number, e.g. "auto")."""
    if requested:
        return requested
    value = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return int(value)
    except ValueError:
        return int(df.sparkSession.sparkContext.defaultParallelism)


def with_positions(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (),
                   pos_col: str = "_pos", count_col: str = "_n",
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col`` (1-based position inside the group ``by`` under ``order``)
    and ``count_col`` (group size).

    ``order`` is a list of sort expressions (e.g. ``F.col("x").desc_nulls_last()``);
    include a unique tie-break so the numbering is deterministic.
    """
    by = list(by)
    keys = [F.col(c).asc_nulls_last() for c in by] + list(order)
    n = _num_partitions(df, num_partitions)
    staged = written(df.repartitionByRange(n, *keys)
                     .sortWithinPartitions(*keys)
                     .withColumn("_mid", F.monotonically_increasing_id()), "positions")
    staged = (staged
              .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
              .withColumn("_li", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
              .drop("_mid"))

    grp = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    gnames = [f"_g{i}" for i in range(len(by))]
    stats = staged.groupBy(F.col("_pid").alias("_spid"), *grp).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_li").alias("_first"))
    w_prefix = (Window.partitionBy(*gnames).orderBy("_spid") if gnames else Window.orderBy("_spid"))
    w_total = Window.partitionBy(*gnames) if gnames else Window.partitionBy()
    stats = (stats
             .withColumn("_before", F.coalesce(
                 F.sum("_cnt").over(w_prefix.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn(count_col, F.sum("_cnt").over(w_total))
             .drop("_cnt"))

    cond = [staged["_pid"] == stats["_spid"]]
    cond += [staged[c].eqNullSafe(stats[g]) for c, g in zip(by, gnames)]
    # Without groups the stats side has one row per partition: a proven bound.
    # With groups it has at most #groups + #partitions rows: left to Spark.
    right = F.broadcast(stats) if not by else stats
    joined = staged.join(right, on=cond, how="inner")
    return (joined
            .withColumn(pos_col, F.col("_before") + F.col("_li") - F.col("_first") + F.lit(1))
            .drop("_pid", "_li", "_spid", "_first", "_before", *gnames))


def ntile_column(pos: Column, n: Column, k: int) -> Column:
    """SQL ``NTILE(k)`` from a 1-based position and the row count.

    With n = q*k + m, the first m tiles hold q+1 rows and the rest q rows.
    """
    q = F.floor(n / F.lit(k)).cast("long")
    m = (n - q * F.lit(k)).cast("long")
    big = m * (q + F.lit(1))
    head = F.floor((pos - F.lit(1)) / (q + F.lit(1))).cast("long") + F.lit(1)
    tail = m + F.floor((pos - big - F.lit(1)) / q).cast("long") + F.lit(1)
    return F.when(pos <= big, head).otherwise(tail)


def ntile_global(df: DataFrame, k: int, order: Sequence[Column], out_col: str,
                 by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER ([PARTITION BY by] ORDER BY order)`` computed in parallel.

    ``order`` must end in a unique tie-break; the result equals SQL NTILE under it.
    """
    pos_col, cnt_col = f"_{out_col}_pos", f"_{out_col}_n"
    p = with_positions(df, order, by=by, pos_col=pos_col, count_col=cnt_col,
                       num_partitions=num_partitions)
    return (p.withColumn(out_col, ntile_column(F.col(pos_col), F.col(cnt_col), k).cast("long"))
            .drop(pos_col, cnt_col))


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
                    num_partitions: int | None = None, decimal_scale: int | None = None) -> DataFrame:
    """``selection.group_quantiles``; ``num_partitions`` is of no use any more and ignored."""
    return selection.group_quantiles(df, by, value, probs, decimal_scale=decimal_scale)

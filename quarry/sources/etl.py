"""Load a set of sources into a persisted Parquet table set, with a row-count audit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.sources.store import Source, versions
from quarry.sources.tables import TableSet


def load_tables(spark: SparkSession, sources: Mapping[str, Source], dst: str, *,
                partition_by: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Write every source to ``<dst>/<name>.parquet``, replacing what was there table by table.

    ``sources`` maps a table name to a DataFrame or a function building one.
    Each write is a distributed job (one file per task; no data passes the
    driver). Returns the audit: (table, row_count), counted while the rows are
    written. ``store.replace_store`` replaces all tables as one unit and can
    cluster them for joins; a folder that it wrote is refused here.
    """
    if versions(spark, dst):
        raise ValueError(f"{dst!r} holds a versioned store; write it with quarry.sources.store.replace_store")
    partition_by, counts = partition_by or {}, []
    for name, src in sources.items():
        df, counted = src(spark) if callable(src) else src, Observation()
        w = df.observe(counted, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite")
        if partition_by.get(name):
            w = w.partitionBy(*partition_by[name])
        w.parquet(f"{dst.rstrip('/')}/{name}.parquet")
        counts.append((name, counted.get["row_count"]))
    return spark.createDataFrame(counts, "table string, row_count long")


def audit(tables: TableSet) -> DataFrame:
    """One (table, row_count) row per table, as a single union of global counts."""
    parts = [tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table"), "row_count")
             for n in tables.names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

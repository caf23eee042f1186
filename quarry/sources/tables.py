"""Parquet table sets: one folder, one ``<name>.parquet`` per table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# The table names of the supplied test data set.
TESTDATA_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                   "events", "documents", "embeddings", "pages", "benchmark", "labels",
                   "conversations")


class TableSet:
    """Lazy access to ``<folder>/<name>.parquet`` tables: ``ts.orders``, ``ts["orders"]``.

    Reading is lazy; Catalyst prunes columns and pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, folder: str, names: Iterable[str] = TESTDATA_TABLES):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.names = tuple(names)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.names:
            raise AttributeError(name)
        return self[name]

    def register(self) -> None:
        """Register every table as a temp view of the same name (for ``spark.sql``)."""
        for n in self.names:
            self[n].createOrReplaceTempView(n)


def open_store(spark: SparkSession, folder: str, names: Iterable[str]) -> TableSet:
    """Open a persisted table set on any file system Spark reads, failing early with guidance
    if a table is missing: the last finished load of a store, or a plain folder of Parquet tables."""
    from quarry.sources.store import VersionedStore, versions
    names = tuple(names)
    if versions(spark, folder):
        store = VersionedStore(spark, folder)
        missing = [n for n in names if n not in store.tables]
        store.names = names
    else:
        store = TableSet(spark, folder, names)
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()

        def exists(name: str) -> bool:
            path = jvm.org.apache.hadoop.fs.Path(store.path(name))
            return path.getFileSystem(conf).exists(path)
        missing = [n for n in names if not exists(n)]
    if missing:
        raise FileNotFoundError(
            f"table store {folder!r} lacks {missing}; build it first with "
            "quarry.sources.etl.load_tables(spark, sources, folder)")
    return store

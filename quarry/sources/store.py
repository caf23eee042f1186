"""A persisted table set that is replaced as one unit.

``<folder>/v00000007/<table>.parquet`` holds the tables of load 7 and ``<folder>/manifest-00000007.json``
names them, with their row counts, schemas and clustering. A load writes its tables first and then
renames its manifest into place; readers take the manifest with the highest number. A load that fails
on the way leaves no manifest, so the store stays as it was.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.sources.tables import TableSet

Source = DataFrame | Callable[[SparkSession], DataFrame]
_MANIFEST = re.compile(r"^manifest-(\d{8})\.json$")


def _files(spark: SparkSession, folder: str):
    """The JVM's Hadoop path class and the file system of ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _children(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _files(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the loads that ended, ascending."""
    return sorted(int(m[1]) for m in map(_MANIFEST.match, _children(spark, folder)) if m)


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict | None:
    """The manifest of ``version`` (the last one by default), None if there is none."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        return None
    path = f"{folder.rstrip('/')}/manifest-{known[-1] if version is None else version:08d}.json"
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def replace_store(spark: SparkSession, sources: Mapping[str, Source], folder: str, *,
                  partition_by: Mapping[str, list[str]] | None = None,
                  clustered: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """Write ``sources`` as the next version of the store and return its audit (table, row_count).

    Rows are counted while they are written. ``clustered`` maps a table to (key, buckets): its rows are
    hashed by the key into that many sorted files, and joins or groupings of such tables on that key
    (same number of buckets) need no shuffle when they are read by ``VersionedStore``. A bucket is one
    task, and all rows of one key value lie in one bucket: cluster by keys without hot values, such as
    order ids, and choose buckets for some hundred MB each. One writer at a time.
    """
    folder, partition_by, clustered = folder.rstrip("/"), partition_by or {}, clustered or {}
    unknown = (set(partition_by) | set(clustered)) - set(sources)
    if unknown:
        raise KeyError(f"no source for {sorted(unknown)}")
    # above every number in use, the folders of failed loads included
    used = [int(m[1]) for m in (re.match(r"^(?:v|manifest-)(\d{8})", c) for c in _children(spark, folder)) if m]
    version = max(used, default=0) + 1
    tables = {}
    for name, source in sources.items():
        df = source(spark) if callable(source) else source
        target = f"{folder}/v{version:08d}/{name}.parquet"
        key, buckets = clustered.get(name, (None, 0))
        if key:
            df = df.repartition(buckets, F.col(f"`{key}`"))
        # counted where the rows are written: a task that is run again counts once
        counted = Observation()
        write = df.observe(counted, F.count(F.lit(1)).alias("row_count")).write.mode("errorifexists")
        if name in partition_by:
            write = write.partitionBy(*partition_by[name])
        if key:
            staged = f"store_load_{uuid.uuid4().hex}"
            write.bucketBy(buckets, key).sortBy(key).option("path", target).format("parquet").saveAsTable(staged)
            spark.sql(f"DROP TABLE {staged}")   # an external table: its files stay
        else:
            write.parquet(target)
        tables[name] = {"row_count": counted.get["row_count"], "schema": df.schema.json(),
                        "partition_by": list(partition_by.get(name, [])), "key": key, "buckets": buckets}
    _publish(spark, folder, version, {"version": version, "tables": tables})
    return spark.createDataFrame([(n, t["row_count"]) for n, t in tables.items()], "table string, row_count long")


def _publish(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    path, fs = _files(spark, folder)
    draft, final = path(f"{folder}/.manifest-{uuid.uuid4().hex}"), path(f"{folder}/manifest-{version:08d}.json")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise FileExistsError(f"version {version} of {folder!r} was written by another load")


class VersionedStore(TableSet):
    """The tables of one version of a store. It keeps to that version while later loads run."""

    def __init__(self, spark: SparkSession, folder: str, version: int | None = None):
        content = manifest(spark, folder, version)
        if content is None:
            raise FileNotFoundError(f"no {'version ' + str(version) if version else 'finished load'} in {folder!r}; "
                                    "build it with quarry.sources.store.replace_store(spark, sources, folder)")
        self.version, self.tables = content["version"], content["tables"]
        super().__init__(spark, f"{folder.rstrip('/')}/v{self.version:08d}", self.tables)

    def __getitem__(self, name: str) -> DataFrame:
        table = self.tables[name]
        schema = StructType.fromJson(json.loads(table["schema"]))
        if not table["key"]:
            return self.spark.read.schema(schema).parquet(self.path(name))
        view = f"store_{uuid.uuid5(uuid.NAMESPACE_URL, self.path(name)).hex}"
        if not self.spark.catalog.tableExists(view):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            split = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in table['partition_by'])}) " if table["partition_by"] else ""
            self.spark.sql(f"CREATE TABLE {view} ({columns}) USING parquet {split}CLUSTERED BY (`{table['key']}`) "
                           f"SORTED BY (`{table['key']}`) INTO {table['buckets']} BUCKETS LOCATION '{self.path(name)}'")
            if split:
                self.spark.sql(f"MSCK REPAIR TABLE {view}")
        return self.spark.table(view)

    def audit(self) -> DataFrame:
        """(table, row_count) as counted by the load; no table is read."""
        return self.spark.createDataFrame([(n, t["row_count"]) for n, t in self.tables.items()], "table string, row_count long")

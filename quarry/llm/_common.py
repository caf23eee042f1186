"""Shared helpers: scratch tables in the shared folder, Arrow text buffers, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir, ship_package

GROUP_BYTES = 1 << 19  # text handled at a time inside a task
_M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage is cut and any
    executor may be lost afterwards. Scratch tables live as long as what is made from them, so they are
    packed tighter than Spark's default."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Jobs run inside hand at most ``rows`` rows to a Python worker at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets; a null counts as empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, group_bytes: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``group_bytes`` together, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + group_bytes, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _hash_words(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one slice and the byte each starts at. A word ends at white space
    or where the next document starts."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[doc_starts[(doc_starts >= 0) & (doc_starts <= n)]] = True
    cut[0] = cut[n] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    first = np.flatnonzero(inside & (cut[:n] | ~before))
    last = np.flatnonzero(inside & (cut[1:] | ~after)) + 1
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[last] - sums[first]) * down[first]
    return mix64(h + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), first


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` of some documents and the
    number of the document each belongs to. Works in slices cut at white space, so a very long
    document needs no more memory than its words."""
    hashes, starts, lo, n = [], [], 0, len(data)
    while lo < n:
        hi = min(n, lo + GROUP_BYTES)
        while hi < n and not _SPACE[data[hi]]:
            more = np.flatnonzero(_SPACE[data[hi: hi + 65536]])
            hi = hi + int(more[0]) if len(more) else min(n, hi + 65536)
        h, s = _hash_words(data[lo:hi], offsets - lo)
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(offsets, at, "right") - 1

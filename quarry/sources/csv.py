"""CSV sources: typed by declaration, legacy encodings, missing-value words.

A wide CSV is read with its header (every column as text). Declared columns are
renamed and cast; every other column is kept as text, or typed from all rows
(``infer``), and Catalyst prunes what a query does not use. Rows with a wrong number
of fields can be kept with their raw text (``rescue``). Privacy columns are dropped at once,
so they never reach a cache, a shuffle or a written file.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.functions.exprs import NUMERIC_TEXT
from quarry.sources.infer import as_kind, infer_kinds

# The words pandas' CSV reader turns into missing values by default.
PANDAS_NA_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                   "nan", "null")

# Latin-1 reads every byte; Spark 4 does not accept the name windows-1252.
LEGACY_ENCODING = "ISO-8859-1"

_NUMERIC_TYPES = {"int", "integer", "bigint", "long", "double", "float", "smallint"}


@dataclass(frozen=True)
class Col:
    """A declared column: name in the file, name in Spark, Spark SQL type."""
    source: str
    name: str
    dtype: str = "string"


def snake_case(name: str) -> str:
    """'Days for shipping (real)' -> 'days_for_shipping_real'."""
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()


def _typed(raw, dtype: str, null_words: Sequence[str]):
    c = F.when(~raw.isin(*null_words), raw) if null_words else raw
    t = dtype.lower()
    if t in _NUMERIC_TYPES:
        # a number or NULL: text such as '4d' that Spark's cast would accept is refused
        num = F.when(F.trim(c).rlike(NUMERIC_TEXT), F.trim(c))
        if t in ("int", "integer", "bigint", "long", "smallint"):
            # digits go straight to the integer type; 1.0 or 1e3 by way of an exact decimal; 1.7 is no integer
            exact = num.try_cast("decimal(38,9)")
            return F.coalesce(F.when(num.rlike(r"^[+-]?\d+$"), num).try_cast(t),
                              F.when(exact == F.floor(exact), exact).try_cast(t))
        return F.nanvl(num.try_cast("double"), F.lit(None).cast("double")).cast(t)
    if t == "string":
        return c
    return c.try_cast(t)


def read_csv(spark: SparkSession, path: str, columns: Iterable[Col] | None = None, *,
             encoding: str = "UTF-8", null_words: Sequence[str] = ("",),
             drop: Sequence[str] = (), multiline: bool = False, partial: bool = False,
             infer: bool = False, rescue: str | None = None) -> DataFrame:
    """Read a header CSV (quotes ``"``, doubled quotes inside fields) and return
    the declared columns, typed and renamed, and all others in snake_case.

    ``multiline=True`` allows newlines inside quoted fields, but Spark then reads
    each file in one task (it cannot split a file at an arbitrary newline). So
    it is off by default and switched on only for sources that need it; large
    inputs should come as many files, or be converted once to Parquet
    (``etl.load_tables``).

    Without ``columns`` every column is kept (minus ``drop``) under its
    snake_case name. ``null_words`` become NULL before casting; numeric columns
    also map NaN to NULL (Spark's ``avg`` would not skip NaN). A declared column
    that the file lacks is an error, unless ``partial`` is set.

    Columns that are not declared are text, or with ``infer=True`` of the narrowest
    type that holds all of their values (``infer.infer_kinds``: one job over all
    rows, at this call). ``rescue`` names a further column: the raw text of a row
    that has more or fewer fields than the header, NULL for all other rows. Such a
    row keeps the fields it has, by position, and does not count for ``infer``.
    """
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", multiline).option("encoding", encoding)
              .option("nullValue", None).option("emptyValue", "")
              .option("mode", "PERMISSIVE"))
    raw, broken = reader.csv(path), "_broken_row"
    if rescue:
        fields = [StructField(c, StringType()) for c in [*raw.columns, broken]]
        raw = reader.option("columnNameOfCorruptRecord", broken).option("columnPruning", False).schema(StructType(fields)).csv(path)
    if drop:
        raw = raw.drop(*drop)
    names = [c for c in raw.columns if not (rescue and c == broken)]
    columns = [c for c in columns or () if not partial or c.source in names]
    others = [c for c in names if c not in {d.source for d in columns}]

    def text(name: str):
        return _typed(F.col(f"`{name}`"), "string", null_words)
    kinds = {}
    if infer and others:
        whole = raw.filter(F.col(broken).isNull()) if rescue else raw
        kinds = infer_kinds(whole.select(*[text(c).alias(c) for c in others]), others)
    out = [_typed(F.col(f"`{c.source}`"), c.dtype, null_words).alias(c.name) for c in columns]
    taken = {c.name for c in columns} | ({rescue} if rescue else set())
    for name in others:
        plain = snake_case(name)
        while plain in taken:
            plain += "_text"
        taken.add(plain)
        value = as_kind(text(name), kinds[name]) if name in kinds else text(name)
        if name in kinds and kinds[name].dtype == "double":
            value = F.nanvl(value, F.lit(None).cast("double"))
        out.append(value.alias(plain))
    if rescue:
        # Spark does not scan for the raw text alone: a field comes along, and never is the result
        field = F.col(f"`{names[0]}`")
        out.append(F.coalesce(F.when(F.length(field) < 0, field), F.col(broken)).alias(rescue))
    return raw.select(*out)

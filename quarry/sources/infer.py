"""Types of text columns, from all rows.

Every text value is mapped to the set of types that can hold it, as the bits of an integer. A
column's type is the first one in the bitwise AND over all its values. That aggregate combines within
and across tasks, so one pass over the rows serves all columns, and one row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import NUMERIC_TEXT


@dataclass(frozen=True)
class Kind:
    """A type that a column of text may get; ``pattern`` is for dates in another than ISO order."""
    name: str
    dtype: str
    pattern: str | None = None


# narrowest first
KINDS = (Kind("boolean", "boolean"), Kind("long", "bigint"), Kind("wide", "decimal(38,0)"), Kind("double", "double"),
         Kind("date", "date"), Kind("date_dmy", "date", "d/M/yyyy"), Kind("date_mdy", "date", "M/d/yyyy"),
         Kind("timestamp", "timestamp_ntz"))
TEXT = Kind("text", "string")

_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_ISO_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"
_WHOLE = r"^-?(0|[1-9]\d*)$"
_CODE = r"^(\+|-?0\d)"        # a sign or zeros in front that a number would lose: postcodes, dial codes
_NOT_FINITE = r"(?i)^(nan|[+-]?inf(inity)?)$"
_SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"


def as_kind(text: Column, kind: Kind) -> Column:
    """``text`` as a value of ``kind``; NULL if it is none."""
    t = F.trim(text)
    if kind.name == "text":
        return text
    if kind.name == "boolean":
        yes = F.lower(t).isin("true", "t", "yes")
        return F.when(yes | F.lower(t).isin("false", "f", "no"), yes)
    if kind.name in ("long", "wide"):
        return F.when(t.rlike(_WHOLE), t).try_cast(kind.dtype)
    if kind.name == "double":
        number = F.when(t.rlike(NUMERIC_TEXT) & ~t.rlike(_CODE), t).try_cast("double")
        return F.when(t.rlike(_NOT_FINITE), t.try_cast("double")).when(F.abs(number) < float("inf"), number)
    if kind.pattern:
        return F.try_to_timestamp(F.when(t.rlike(_SLASH_DATE), t), F.lit(kind.pattern)).cast("date")
    return F.when(t.rlike(_ISO_DATE if kind.name == "date" else _ISO_TIMESTAMP), t).try_cast(kind.dtype)


def infer_kinds(df: DataFrame, columns: Sequence[str]) -> dict[str, Kind]:
    """The narrowest kind that holds every value of each text column; NULLs do not count.

    Whole numbers are long, or decimal(38,0) where one is beyond a long, so no digit of a long id is
    lost; numbers with a fraction or an exponent are double. Slashed dates are read day first if all
    rows allow it, else month first. Numbers with a plus or zeros in front (codes) or beyond a double,
    times of day, a column of unlike kinds (dates and timestamps, too) and one without any value stay
    text. Runs one job over all rows of ``df``.
    """
    names = list(columns)
    if not names:
        return {}

    def mask(name: str) -> Column:
        value, bits = F.col(f"`{name}`"), F.lit(0)
        for i, kind in enumerate(KINDS):
            bits = bits.bitwiseOR(F.when(as_kind(value, kind).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)))
        return F.when(value.isNotNull(), bits)
    row = df.agg(*[F.bit_and(mask(n)).alias(f"_{i}") for i, n in enumerate(names)]).first()
    return {n: next((k for b, k in enumerate(KINDS) if (row[i] or 0) >> b & 1), TEXT) for i, n in enumerate(names)}

"""List-in-a-string columns: one row per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import col, split_list


def explode_tokens(df: DataFrame, text: str, sep: str, alias: str,
                   keep: Sequence[str] = ()) -> DataFrame:
    """``SELECT TRIM(t) AS alias, keep... FROM df, UNNEST(string_split(text, sep)) t
    WHERE text IS NOT NULL``. Only ``keep`` columns are carried into the
    explode, so the multiplied rows stay narrow. Empty tokens are kept."""
    return (df.filter(col(text).isNotNull())
            .select(*keep, F.explode(split_list(text, sep)).alias("_tok"))
            .select(F.trim(F.col("_tok")).alias(alias), *keep))

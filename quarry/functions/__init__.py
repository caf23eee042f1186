"""Scalar and aggregate column helpers (built-in Spark expressions only)."""

from quarry.functions.exprs import (  # noqa: F401
    NUMERIC_TEXT, avg_where, col, day_diff, discount_pct, flag, half_even_round, month_index,
    month_start, path_segment, rate_pct, rounded, safe_corr, safe_divide, safe_double,
    split_list, sql_round, tier_bin,
)

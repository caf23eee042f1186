"""Reusable analytic operators: DataFrame in, DataFrame out, column names as arguments."""

from quarry.operators.correlation import correlations, correlations_long  # noqa: F401
from quarry.operators.distribution import distribution_by_group, group_outliers  # noqa: F401
from quarry.operators.explode import explode_tokens  # noqa: F401
from quarry.operators.explorer import filtered_explorer, optional_filter  # noqa: F401
from quarry.operators.fanout import fanout_summary, review_weights  # noqa: F401
from quarry.operators.groups import (  # noqa: F401
    counted_options, distinct_options, group_profile, kpi_summary, order_person_totals,
)
from quarry.operators.growth import (  # noqa: F401
    cohort_activity, period_growth, repeat_rate, retention_pct, retention_triangle,
)
from quarry.operators.positions import ntile_global, with_positions  # noqa: F401
from quarry.operators.ranking import top_k, topk_per_group  # noqa: F401
from quarry.operators.reshape import (  # noqa: F401
    melt, missing_counts, pivot_wide, sentinel_share, table_profile, value_counts,
)
from quarry.operators.rfm import customer_rfm, rfm_summary  # noqa: F401
from quarry.operators.selection import group_quantiles, ntiles  # noqa: F401

from assayline.operators.filters import apply_filters, filter_members
from assayline.operators.keyed import first_per_key, latest_per_key
from assayline.operators.metrics import Metrics
from assayline.operators.outliers import flag_iqr_outliers, iqr_bounds
from assayline.operators.profile import (
    distinct_values,
    group_counts,
    null_profile,
    top_labels,
)
from assayline.operators.quantiles import exact_quantiles, median_and_sums
from assayline.operators.ranking import best_worst_k, rank_top
from assayline.operators.rollup import status_counts, with_rates
from assayline.operators.shape import (
    expand_codes,
    handle_missing,
    nested_to_json,
    select_existing,
    with_load_ts,
)

__all__ = [
    "Metrics",
    "apply_filters",
    "best_worst_k",
    "distinct_values",
    "exact_quantiles",
    "expand_codes",
    "filter_members",
    "first_per_key",
    "flag_iqr_outliers",
    "group_counts",
    "handle_missing",
    "iqr_bounds",
    "latest_per_key",
    "median_and_sums",
    "nested_to_json",
    "null_profile",
    "rank_top",
    "select_existing",
    "status_counts",
    "top_labels",
    "with_load_ts",
    "with_rates",
]

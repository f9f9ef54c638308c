from assayline.functions.codes import (
    contains_any,
    keyword_category,
    plain_keyword_category,
    label_norm,
    map_codes,
    surrogate_key,
    worst_of_status,
)
from assayline.functions.numbers import (
    marker_size,
    parse_qualified_number,
    pct,
    qualified_result,
    threshold_flag,
    weighted_mean,
)
from assayline.functions.places import in_bbox
from assayline.functions.times import load_ts, parse_day, parse_instant, period_label

__all__ = [
    "contains_any",
    "in_bbox",
    "keyword_category",
    "plain_keyword_category",
    "label_norm",
    "load_ts",
    "map_codes",
    "marker_size",
    "parse_day",
    "parse_instant",
    "parse_qualified_number",
    "pct",
    "period_label",
    "qualified_result",
    "surrogate_key",
    "threshold_flag",
    "weighted_mean",
    "worst_of_status",
]

from tripflow.functions.expr import (
    count_if,
    in_month,
    label,
    month_bounds,
    present,
    rnd,
    safe_div,
    seconds_between,
    ts_literal,
)
from tripflow.functions.features import add_features, feature_columns

__all__ = [
    "add_features",
    "count_if",
    "feature_columns",
    "in_month",
    "label",
    "month_bounds",
    "present",
    "rnd",
    "safe_div",
    "seconds_between",
    "ts_literal",
]

from tripflow.operators.outliers import (
    Bounds,
    Tuning,
    bounds_table,
    choose_multiplier,
    iqr_bounds,
    iqr_candidates,
    iqr_filter,
    iqr_filter_with_bounds,
    pick_multiplier,
    tuned_iqr_filter,
)
from tripflow.operators.profile import (
    Check,
    count_by,
    describe_numeric,
    distribution,
    duplicate_stats,
    duplicate_stats_from_copies,
    histogram,
    issues,
    null_counts,
    quantiles,
    shape,
    value_ranges,
)
from tripflow.operators.quantile_select import QuantileTarget, column_ranges, exact_quantiles
from tripflow.operators.report import layer_report, pivot_matrix, share
from tripflow.operators.rules import (
    Rule,
    Step,
    apply_rules,
    clean,
    dedupe,
    funnel,
    quarantine,
    require,
    required_rules,
    tag_rows,
)
from tripflow.operators.summarise import Label, Measure, Summary, summarise, summarise_many, top_k

__all__ = [name for name in dir() if not name.startswith("_")]

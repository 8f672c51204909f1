"""DataFrame to DataFrame operators."""

from grainline.operators.adjustments import apply_adjustments, run_statement, transfers
from grainline.operators.calendars import (
    day_streaks,
    month_bits,
    retention_of_bits,
    returns_of_bits,
    streaks_of_bits,
)
from grainline.operators.cohorts import cohort_retention, cohort_shares, cohorts, with_cohort
from grainline.operators.duplicates import (
    dedupe_keep_latest,
    duplicates,
    in_both,
    only_left,
    union_all,
    union_distinct,
)
from grainline.operators.gaps import inactivity_gaps, month_reactivations, purchase_gaps
from grainline.operators.hierarchy import hierarchy_levels, hierarchy_totals
from grainline.operators.lifecycle import churned, conversion_rate, with_segment
from grainline.operators.lookups import (
    attach,
    by_key,
    hierarchy_parent,
    matched,
    never_matched,
    roots,
)
from grainline.operators.ordering import (
    compare_ranks,
    cumulative,
    global_row_number,
    group_row_number,
    positions,
)
from grainline.operators.ranking import (
    nth_highest,
    peers_of_max,
    rows_at_nth_highest,
    top_k,
    top_k_per_group,
)
from grainline.operators.rollup import (
    group_sum,
    groups_where_average,
    period_revenue,
    rollup_years,
)
from grainline.operators.shares import (
    above_average,
    above_group_average,
    group_totals,
    percent_of_total,
    share_of_group,
)
from grainline.operators.sketches import bracketed_quantiles
from grainline.operators.statistics import (
    correlation,
    exact_sample,
    iqr_outliers,
    keyed_sample,
    lookup,
    missing_values,
    mode,
    moments,
    pivot_sum,
    quantiles,
    reconcile,
    reconcile_by_range,
    rule_violations,
    stratified_sample,
    write_checked,
    z_scores,
)
from grainline.operators.streaks import longest_streak, streaks, with_run_length
from grainline.operators.timeseries import (
    best_period,
    latest,
    rolling,
    running,
    with_previous,
    yoy,
)

__all__ = [
    "above_average",
    "above_group_average",
    "apply_adjustments",
    "attach",
    "best_period",
    "bracketed_quantiles",
    "by_key",
    "churned",
    "cohort_retention",
    "cohort_shares",
    "cohorts",
    "compare_ranks",
    "conversion_rate",
    "correlation",
    "cumulative",
    "day_streaks",
    "dedupe_keep_latest",
    "duplicates",
    "exact_sample",
    "global_row_number",
    "group_row_number",
    "group_sum",
    "group_totals",
    "groups_where_average",
    "hierarchy_levels",
    "hierarchy_parent",
    "hierarchy_totals",
    "in_both",
    "inactivity_gaps",
    "iqr_outliers",
    "keyed_sample",
    "latest",
    "longest_streak",
    "lookup",
    "matched",
    "missing_values",
    "mode",
    "moments",
    "month_bits",
    "month_reactivations",
    "never_matched",
    "nth_highest",
    "only_left",
    "peers_of_max",
    "percent_of_total",
    "period_revenue",
    "pivot_sum",
    "positions",
    "purchase_gaps",
    "quantiles",
    "reconcile",
    "reconcile_by_range",
    "retention_of_bits",
    "returns_of_bits",
    "rolling",
    "rollup_years",
    "roots",
    "rows_at_nth_highest",
    "rule_violations",
    "run_statement",
    "running",
    "share_of_group",
    "stratified_sample",
    "streaks",
    "streaks_of_bits",
    "top_k",
    "top_k_per_group",
    "transfers",
    "union_all",
    "union_distinct",
    "with_cohort",
    "with_previous",
    "with_run_length",
    "with_segment",
    "write_checked",
    "yoy",
    "z_scores",
]

from tracelens.operators.counting import (
    count_present,
    distinct_and_rows,
    distinct_count,
    distinct_per_key,
    distinct_rows,
    frequency_of_counts,
    rows_per_key,
    value_counts,
)
from tracelens.operators.histogram import equal_width_histogram, integer_histogram
from tracelens.operators.joins import join_on_keys, semi_join
from tracelens.operators.ordering import bottom_k, sort_by, top_k
from tracelens.operators.shares import rate_per_group, share_of_total, total_of
from tracelens.operators.stats import (
    approx_median,
    correlation,
    exact_median,
    summary_stats,
)
from tracelens.operators.transitions import (
    first_event_time,
    mean_rows_per_key,
    positive_delays,
    transition_delay,
)

__all__ = [
    "approx_median", "bottom_k", "correlation", "count_present", "distinct_and_rows",
    "distinct_count", "distinct_per_key", "distinct_rows", "equal_width_histogram",
    "exact_median", "first_event_time", "frequency_of_counts", "integer_histogram",
    "join_on_keys", "mean_rows_per_key", "positive_delays", "rate_per_group", "rows_per_key",
    "semi_join", "share_of_total", "sort_by", "summary_stats", "top_k", "total_of",
    "transition_delay", "value_counts",
]

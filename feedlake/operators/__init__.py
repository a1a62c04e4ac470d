from feedlake.operators.drift import stage_drift
from feedlake.operators.measures import (
    drilldown,
    per_default_window,
    record_total,
    weekly_run_dates,
)
from feedlake.operators.paging import deep_limit_offset, limit_offset, page_counts
from feedlake.operators.quality import duplicate_keys, missing_days
from feedlake.operators.ranges import day_range, in_window
from feedlake.operators.typed import bad_value_count, rejects, typed_rows

__all__ = [
    "bad_value_count",
    "day_range",
    "deep_limit_offset",
    "drilldown",
    "duplicate_keys",
    "in_window",
    "limit_offset",
    "missing_days",
    "page_counts",
    "per_default_window",
    "record_total",
    "rejects",
    "stage_drift",
    "typed_rows",
    "weekly_run_dates",
]

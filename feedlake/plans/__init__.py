from feedlake.plans.backfills import backfill, read_ledger, windows
from feedlake.plans.daily import (
    DailySums,
    append_summed,
    create_sums,
    daily_sums,
    finish_sums,
    refresh_sums,
    summed_again,
)
from feedlake.plans.jobs import (
    LoadReport,
    append_stage,
    footprint,
    load_feed,
    replace_from_stage,
    stage_measure,
    stage_rejects,
)
from feedlake.plans.tables import (
    FeedTable,
    append,
    create_if_absent,
    create_raw,
    create_statement,
    finish_replacements,
    read_window,
    replace_window,
)
from feedlake.plans.upserts import UpsertReport, newest_per_key, upsert

__all__ = [
    "DailySums",
    "FeedTable",
    "LoadReport",
    "UpsertReport",
    "append",
    "append_stage",
    "append_summed",
    "backfill",
    "create_if_absent",
    "create_raw",
    "create_statement",
    "create_sums",
    "daily_sums",
    "finish_replacements",
    "finish_sums",
    "footprint",
    "load_feed",
    "newest_per_key",
    "read_ledger",
    "read_window",
    "refresh_sums",
    "replace_from_stage",
    "replace_window",
    "stage_measure",
    "stage_rejects",
    "summed_again",
    "upsert",
    "windows",
]

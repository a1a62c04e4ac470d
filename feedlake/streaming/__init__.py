from feedlake.streaming.incremental import (
    compact_batches,
    days_done,
    load_batch,
    load_new_days,
    load_new_files,
    report_new_rejects,
)

__all__ = [
    "compact_batches",
    "days_done",
    "load_batch",
    "load_new_days",
    "load_new_files",
    "report_new_rejects",
]

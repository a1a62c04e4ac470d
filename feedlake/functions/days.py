"""Dates: parsing, literals and load windows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default window starts 8 days before the run date and stops 1 day before it.
START_LAG_DAYS = 8
STOP_LAG_DAYS = 1

# Fixed value: what follows the day in the feed's range parameters.
MIDNIGHT = "T00:00:00.00"


def parse_day(text: Column | str) -> Column:
    """Date written as year-month-day, padded or not; NULL when it is anything else."""
    return F.try_to_date(text, "yyyy-M-d")


def midnight_literal(day: Column | str) -> Column:
    """ISO text of the day's midnight; a time of day is dropped."""
    return F.concat(F.to_date(day).cast("string"), F.lit(MIDNIGHT))


def midnight_text(day: datetime.date) -> str:
    """`midnight_literal` for a Python date, for use in a feed request."""
    return f"{day:%Y-%m-%d}{MIDNIGHT}"


def default_bounds(run_date: Column | str) -> tuple[Column, Column]:
    """First day and end day (exclusive) of the window a run on `run_date` loads."""
    return F.date_sub(run_date, START_LAG_DAYS), F.date_sub(run_date, STOP_LAG_DAYS)


def load_window(
    run_date: datetime.date,
    start: datetime.date | None = None,
    stop: datetime.date | None = None,
    open_end: bool = False,
) -> tuple[datetime.date, datetime.date | None]:
    """Half-open window of one run: given bounds are kept, missing ones take the default.

    `open_end=True` leaves a missing stop open, so that the window runs to the newest row.
    """
    if start is None:
        start = run_date - datetime.timedelta(days=START_LAG_DAYS)
    if stop is None and not open_end:
        stop = run_date - datetime.timedelta(days=STOP_LAG_DAYS)
    if stop is not None and stop < start:
        raise ValueError(f"window stops at {stop}, before it starts at {start}")
    return start, stop

"""Half-open ranges of days."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_range(
    start: datetime.date | None, stop: datetime.date | None = None, column: str = "date"
) -> Column:
    """`start <= column < stop`; a bound that is None is left open."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(column) >= F.lit(start))
    if stop is not None:
        inside = inside & (F.col(column) < F.lit(stop))
    return inside


def in_window(
    df: DataFrame,
    start: datetime.date | None,
    stop: datetime.date | None = None,
    column: str = "date",
) -> DataFrame:
    """Rows of the window. Bare comparisons of the column, so that they reach the scan."""
    return df.where(day_range(start, stop, column))

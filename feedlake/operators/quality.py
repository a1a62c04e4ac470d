"""Reports over a loaded table: repeated keys and missing days."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.schema import KEY_COLUMNS


def duplicate_keys(rows: DataFrame, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    """Keys that occur more than once, with how often. Copies are counted, never collected."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def missing_days(
    rows: DataFrame, start: datetime.date, stop: datetime.date, by: list[str] | None = None
) -> DataFrame:
    """Days of `[start, stop)` without a row; with `by`, per value that occurs in `rows`.

    One scan and one shuffle: the days that a value has are a set no longer than the range, and
    what the range has besides is taken from it in the row. Rows outside the range only name their
    value.
    """
    by = by or []
    if stop <= start:
        return rows.select(*by, "date").limit(0)
    last = stop - datetime.timedelta(days=1)
    inside = (F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(stop))
    held = rows.groupBy(*by).agg(F.collect_set(F.when(inside, F.col("date"))).alias("days"))
    days = F.sequence(F.lit(start), F.lit(last))
    return held.select(*by, F.explode(F.array_except(days, "days")).alias("date"))

"""Grouped measures and counts per load window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from feedlake.functions.days import START_LAG_DAYS, default_bounds


def drilldown(df: DataFrame, by: str, measure: Column, name: str) -> DataFrame:
    """Sum of one measure, and the rows behind it, per value of one dimension.

    Spark sums within each task before it shuffles, so a value that holds most rows costs one
    partial row per task.
    """
    return df.groupBy(by).agg(F.sum(measure).alias(name), F.count("*").alias("n_rows"))


def record_total(responses: DataFrame, text: str, record: StructType | str) -> DataFrame:
    """`n_responses, n_records`: JSON texts that each hold an array of records, and their records.

    A text that is no such array, or null, holds none.
    """
    decoded = F.from_json(F.col(text), ArrayType(_struct(record)))
    return responses.select(F.coalesce(F.size(decoded), F.lit(0)).alias("n")).agg(
        F.count("*").alias("n_responses"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_records")
    )


def _struct(record: StructType | str) -> StructType:
    return record if isinstance(record, StructType) else StructType.fromDDL(record)


def weekly_run_dates(days: DataFrame, column: str = "date") -> DataFrame:
    """Every Monday whose default window can touch the span of `column`, as `run_date`."""
    span = days.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    mondays = F.sequence(
        F.next_day("first", "Mon"),
        F.date_add("last", START_LAG_DAYS),
        F.expr("interval 7 days"),
    )
    return span.select(F.explode(mondays).alias("run_date"))


def per_default_window(rows: DataFrame, run_dates: DataFrame, *aggs: tuple[str, str]) -> DataFrame:
    """Per run date: its window, its row count, and sums `(column, alias)` over its rows.

    Rows are summed to one per day before anything is joined, and each window is spelled out
    as its seven days, so the join is an equality on the day and never a range.
    """
    daily = rows.groupBy("date").agg(
        F.count("*").alias("n_rows"), *[F.sum(c).alias(a) for c, a in aggs]
    )
    start, stop = default_bounds("run_date")
    windows = run_dates.select("run_date", start.alias("start_date"), stop.alias("stop_date"))
    window_days = windows.select(
        "*", F.explode(F.sequence("start_date", F.date_sub("stop_date", 1))).alias("date")
    )
    joined = window_days.join(daily, "date", "left")
    return joined.groupBy("run_date", "start_date", "stop_date").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *[F.coalesce(F.sum(a), F.lit(0)).alias(a) for _, a in aggs],
    )

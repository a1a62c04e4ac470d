"""Backfills in windows that can be broken off and gone on with."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.plans.jobs import LoadReport, load_feed
from feedlake.plans.tables import FeedTable

LEDGER_SCHEMA = (
    "table_name string, start date, stop date, n_rows bigint, n_bad_values bigint, "
    "n_corrupt_lines bigint, n_without_date bigint, n_outside_window bigint, done_at timestamp"
)


def windows(
    start: datetime.date, stop: datetime.date, days: int
) -> list[tuple[datetime.date, datetime.date]]:
    """`[start, stop)` cut into windows of so many days; the last may be shorter."""
    if days < 1 or stop <= start:
        raise ValueError(f"no windows of {days} days from {start} to {stop}")
    step = datetime.timedelta(days=days)
    edges = [start + k * step for k in range(-(-(stop - start) // step))] + [stop]
    return list(zip(edges[:-1], edges[1:]))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The windows that are done, each with its load's report; the last report of each counts."""
    lines = spark.read.schema(LEDGER_SCHEMA).json(ledger)
    latest = F.max_by(F.struct(*lines.columns), "done_at").alias("last")
    return lines.groupBy("table_name", "start", "stop").agg(latest).select("last.*")


def backfill(
    spark: SparkSession,
    pull: Callable[[datetime.date, datetime.date], DataFrame],
    stage: str,
    table: FeedTable,
    ledger: str,
    start: datetime.date,
    stop: datetime.date,
    days: int = 366,
) -> list[LoadReport]:
    """Load `[start, stop)` window by window, but for the windows that `ledger` has as done.

    `pull(start, stop)` gives the wire rows of a window, which are staged in a folder of their own
    and replace the table's rows of it. Then the window is written to the ledger, a folder of JSON
    lines. A run that breaks off is gone on with by the same call: the window that it was at is
    replaced again, those before are not pulled. Returns the reports of the windows of this call.
    """
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").json(ledger)
    rows = read_ledger(spark, ledger).where(F.col("table_name") == table.name)
    # one row per window of this table
    done = {(r.start, r.stop) for r in rows.select("start", "stop").collect()}
    reports = []
    for window in windows(start, stop, days):
        if window in done:
            continue
        folder = f"{stage}/{window[0].isoformat()}_{window[1].isoformat()}"
        report = load_feed(spark, pull(*window), folder, table, window)
        line = (
            table.name, *window, report.n_rows, report.n_bad_values, report.n_corrupt_lines,
            report.n_without_date, report.n_outside_window, datetime.datetime.now(datetime.UTC),
        )
        noted = spark.createDataFrame([line], LEDGER_SCHEMA)
        noted.write.mode("append").json(ledger)
        reports.append(report)
    return reports

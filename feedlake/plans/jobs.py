"""Whole loads: stage a feed, load the stage into a table, compare storage formats."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.measures import drilldown
from feedlake.operators.ranges import day_range
from feedlake.operators.typed import bad_value_count, is_corrupt, rejects, typed_columns
from feedlake.plans.tables import (
    FeedTable,
    arranged,
    create_if_absent,
    insert,
    replace_counted,
)
from feedlake.schema import WIRE_SCHEMA
from feedlake.sources.staged import read_stage, write_stage


@dataclass(frozen=True)
class LoadReport:
    """What became of the staged lines, counted while writing.

    `n_rows` were loaded. Left out were `n_corrupt_lines`, and by the load of a window also
    `n_without_date` and `n_outside_window`; the four add up to the lines. `n_bad_values` of all
    rows had no typed form and are NULL.
    """

    n_rows: int
    n_bad_values: int
    n_corrupt_lines: int
    n_without_date: int = 0
    n_outside_window: int = 0


def read_for_load(spark: SparkSession, stage: str) -> DataFrame:
    return read_stage(spark, stage, WIRE_SCHEMA, keep_corrupt=True)


def marked_rows(wire: DataFrame) -> DataFrame:
    """Typed rows, with whether the line was corrupt and how many values could not be typed."""
    return wire.select(
        *typed_columns(), is_corrupt(wire).alias("_corrupt"), bad_value_count().alias("_bad")
    )


def replace_from_stage(
    spark: SparkSession,
    stage: str,
    table: FeedTable,
    start: datetime.date,
    stop: datetime.date | None = None,
) -> LoadReport:
    """Type the staged rows and replace the table's rows of the window by them, in one pass."""
    create_if_absent(spark, table)
    corrupt = F.col("_corrupt")
    undated = ~corrupt & F.col("date").isNull()
    outside = ~corrupt & ~F.coalesce(day_range(start, stop), F.lit(True))
    metrics = {
        "n_bad_values": F.coalesce(F.sum("_bad"), F.lit(0)),
        "n_corrupt_lines": F.count_if(corrupt),
        "n_without_date": F.count_if(undated),
        "n_outside_window": F.count_if(outside),
    }
    marked = marked_rows(read_for_load(spark, stage))
    counted = replace_counted(
        spark, table, marked, start, stop, wanted=~corrupt, metrics=metrics
    )
    return LoadReport(**counted)


def append_stage(spark: SparkSession, stage: str, table: FeedTable) -> LoadReport:
    """Type the staged rows and append them, in one pass over the stage.

    Values without a typed form load as NULL and unreadable lines are left out; the report says
    how many there were, and `stage_rejects` which.
    """
    create_if_absent(spark, table)
    wire = read_for_load(spark, stage)
    marked = marked_rows(wire)
    counted = Observation()
    # counted after the shuffle, in the stage that writes: a task that runs again counts once
    ready = arranged(table, marked).observe(
        counted,
        F.count_if(~F.col("_corrupt")).alias("n_rows"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("n_bad_values"),
        F.count_if("_corrupt").alias("n_corrupt_lines"),
    )
    insert(spark, table, ready.where(~F.col("_corrupt")).drop("_corrupt", "_bad"))
    return LoadReport(**counted.get)


def stage_rejects(spark: SparkSession, stage: str) -> DataFrame:
    """The values and lines of a stage that a load could not take over as they are."""
    return rejects(read_for_load(spark, stage))


def load_feed(
    spark: SparkSession,
    pulled: DataFrame,
    stage: str,
    table: FeedTable,
    window: tuple[datetime.date, datetime.date | None] | None = None,
) -> LoadReport:
    """Stage the pulled wire rows as JSON, create the table if absent, and load the stage.

    A backfill is the same call with more rows: one job, however many days it spans. Without a
    `window` the rows are appended; with one they replace the table's rows of it, and a window
    whose stop is None has no end.
    """
    create_if_absent(spark, table)
    write_stage(pulled, stage)
    if window is None:
        return append_stage(spark, stage, table)
    return replace_from_stage(spark, stage, table, *window)


def stage_measure(df: DataFrame, by: str, measure: Column, name: str, path: str) -> int:
    """One measure per value of a dimension, written as JSON; returns how many records."""
    counted = Observation()
    write_stage(drilldown(df, by, measure, name).observe(counted, F.count("*").alias("n")), path)
    return counted.get["n"]


def footprint(spark: SparkSession, stored: dict[str, tuple[str, str]]) -> DataFrame:
    """Files, bytes and rows per entry of `{label: (format, directory)}`.

    Sizes come from a file scan that reads no content, rows from a count in each format.
    """
    parts = []
    for label, (file_format, directory) in stored.items():
        sizes = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "part-*")
            .load(directory)
            .select(F.lit(1).alias("files"), F.col("length").alias("bytes"), F.lit(0).alias("rows"))
        )
        reader = spark.read.format(file_format)
        if file_format == "json":
            reader = reader.schema(WIRE_SCHEMA)
        counts = reader.load(directory).select(
            F.lit(0).alias("files"), F.lit(0).cast("long").alias("bytes"), F.lit(1).alias("rows")
        )
        parts.append(sizes.union(counts).withColumn("format", F.lit(label)))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.union(part)
    return everything.groupBy("format").agg(
        F.sum("files").alias("n_files"),
        F.sum("bytes").alias("n_bytes"),
        F.sum("rows").alias("n_rows"),
    )

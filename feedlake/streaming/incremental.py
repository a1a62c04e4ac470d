"""Loading a stage as it grows: every staged file is loaded once, however often this runs.

A batch's rows lie in partitions of its own, one per day, so that a batch that is repeated replaces
what it wrote. `compact_batches` merges a day's partitions of batches that will not be repeated.
"""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake import files
from feedlake.operators.typed import rejects
from feedlake.plans.jobs import LoadReport, marked_rows
from feedlake.plans.tables import (
    FeedTable,
    add_partitions,
    arranged,
    create_if_absent,
    drop_partitions,
    overwrite_files,
    partition_values,
)
from feedlake.schema import BATCH_COLUMN, WIRE_SCHEMA
from feedlake.sources.paged import DEFAULT_PAGE_SIZE
from feedlake.sources.staged import staged_schema


def _new_files(spark: SparkSession, stage: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(staged_schema(WIRE_SCHEMA))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(stage)


def load_batch(table: FeedTable, wire: DataFrame, batch: int) -> LoadReport:
    """Make the table's rows of one batch those of `wire`; running it again changes nothing.

    The batch's number is kept with its rows as a partition, and a repeated batch overwrites the
    partitions that it wrote before.
    """
    counted = Observation()
    ready = arranged(table, marked_rows(wire).withColumn(BATCH_COLUMN, F.lit(batch))).observe(
        counted,
        F.count_if(~F.col("_corrupt")).alias("n_rows"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("n_bad_values"),
        F.count_if("_corrupt").alias("n_corrupt_lines"),
        F.collect_set(F.when(~F.col("_corrupt"), F.struct("date"))).alias("_days"),
    )
    spark = wire.sparkSession
    overwrite_files(spark, table, ready.where(~F.col("_corrupt")))
    found = counted.get
    # the batch's own partitions, by name: what the table held before is not looked at
    add_partitions(spark, table, [(row["date"], batch) for row in found.pop("_days")])
    return LoadReport(**found)


def merged_number(batch: int) -> int:
    """The number of a partition that holds all batches up to `batch`; it is below zero."""
    return -1 - batch


def _covers(number: int) -> int:
    """The last batch that a partition's number stands for."""
    return number if number >= 0 else -1 - number


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that a checkpoint has done; no batch up to it is ever repeated."""
    names = files.names_in(spark, files.child(spark, checkpoint, "commits"))
    return max((int(name) for name in names if name.isdigit()), default=None)


def compact_batches(
    spark: SparkSession, table: FeedTable, checkpoint: str, most: int = 1
) -> int:
    """Merge the partitions of every day that has over `most` of them; returns how many days.

    Only batches that `checkpoint` has committed are merged, as others may be repeated. A merged
    partition's number says up to which batch it holds the day's rows. It is written whole, then
    added to the catalog, then those that it holds are dropped; if that breaks off, the next call
    drops them. In between a reader may see rows twice: Parquet tables have no snapshots.
    """
    last = last_committed(spark, checkpoint)
    if last is None:
        return 0
    days: dict[str, list[int]] = {}
    for day, number in partition_values(spark, table):
        if _covers(int(number)) <= last:
            days.setdefault(day, []).append(int(number))
    _drop_merged(spark, table, days)
    large = {day: numbers for day, numbers in days.items() if len(numbers) > most}
    if not large:
        return 0
    null = "__HIVE_DEFAULT_PARTITION__"
    named = F.col("date").isin([day for day in large if day != null])
    chosen = named | F.col("date").isNull() if null in large else named
    done = F.when(F.col(BATCH_COLUMN) < 0, -1 - F.col(BATCH_COLUMN)).otherwise(F.col(BATCH_COLUMN))
    rows = spark.table(table.name).where(chosen & (done <= last))
    into = merged_number(last)
    merged = arranged(table, rows.withColumn(BATCH_COLUMN, F.lit(into).cast("long")))
    # the catalog names a table's partitions, so a folder that it does not name is not read
    overwrite_files(spark, table, merged)
    add_partitions(spark, table, [(day, into) for day in large])
    _drop_merged(spark, table, {day: [*numbers, into] for day, numbers in large.items()})
    spark.catalog.refreshTable(table.name)
    return len(large)


def _drop_merged(spark: SparkSession, table: FeedTable, days: dict[str, list[int]]) -> None:
    """Drop every partition whose rows its day's last merged one holds; `days` keeps the others."""
    gone = []
    for day, numbers in days.items():
        merged = [n for n in numbers if n < 0]
        upto = max(map(_covers, merged), default=-1)
        held = [n for n in numbers if _covers(n) <= upto and n != merged_number(upto)]
        gone += [(day, n) for n in held]
        days[day] = [n for n in numbers if n not in held]
    drop_partitions(spark, table, gone)


def load_new_files(
    spark: SparkSession,
    stage: str,
    table: FeedTable,
    checkpoint: str,
    max_files: int | None = None,
    most_partitions: int | None = None,
) -> LoadReport:
    """Load the files staged since the last run into a `batched` table; returns what they held.

    Progress is kept in `checkpoint`, so a run that fails can be started again: the batch that it
    was at is repeated under the same number. `max_files` bounds the files of one batch. With
    `most_partitions`, days that have more are compacted at the end: see `compact_batches`.
    """
    if not table.batched:
        raise ValueError(f"{table.name} keeps no batch numbers")
    create_if_absent(spark, table)
    reports = []
    stream = _new_files(spark, stage, max_files).writeStream.foreachBatch(
        lambda wire, batch: reports.append(load_batch(table, wire, batch))
    )
    stream = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    stream.start().awaitTermination()
    if most_partitions is not None:
        compact_batches(spark, table, checkpoint, most_partitions)
    return _total(reports)


def days_done(spark: SparkSession, checkpoint: str) -> datetime.date | None:
    """The day up to which a stream of a feed's days is read, by its checkpoint."""
    last = last_committed(spark, checkpoint)
    if last is None:
        return None
    noted = files.read_lines(spark, files.child(spark, checkpoint, f"offsets/{last}"))
    return datetime.date.fromisoformat(json.loads(noted[-1])["day"])


def load_new_days(
    spark: SparkSession,
    name: str,
    table: FeedTable,
    checkpoint: str,
    first: datetime.date,
    stop: datetime.date,
    max_days: int | None = None,
    max_tasks: int | None = None,
    page_size: int = DEFAULT_PAGE_SIZE,
) -> LoadReport:
    """Load the days of a registered feed up to `stop` that no run before has loaded.

    The table is a `batched` one. The first run begins with the day `first`; where a run ended is
    kept in `checkpoint`, so the next goes on from there, and one that fails is repeated under the
    same batch number. A `stop` that lies behind is no step back. `max_days` bounds the days of a
    batch, so that a long backlog is loaded in several.
    """
    if not table.batched:
        raise ValueError(f"{table.name} keeps no batch numbers")
    create_if_absent(spark, table)
    reports = []
    while True:
        done = days_done(spark, checkpoint) or first
        upto = max(done, stop)
        if max_days is not None:
            upto = min(upto, done + datetime.timedelta(days=max_days))
        reader = spark.readStream.format(name).option("pageSize", page_size)
        reader = reader.option("minRuns", spark.sparkContext.defaultParallelism)
        if max_tasks is not None:
            reader = reader.option("maxRuns", max_tasks)
        days = reader.option("start", first.isoformat()).option("stop", upto.isoformat()).load()
        stream = days.writeStream.foreachBatch(
            lambda wire, batch: reports.append(load_batch(table, wire, batch))
        )
        stream = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        stream.start().awaitTermination()
        # a batch that a run before had planned comes first, with the end that it had then
        if (days_done(spark, checkpoint) or first) >= stop:
            return _total(reports)


def _total(reports: list[LoadReport]) -> LoadReport:
    return LoadReport(
        sum(r.n_rows for r in reports),
        sum(r.n_bad_values for r in reports),
        sum(r.n_corrupt_lines for r in reports),
    )


def report_new_rejects(
    spark: SparkSession, stage: str, sink: str, checkpoint: str, max_files: int | None = None
) -> None:
    """Add the rejects of files staged since the last run to `sink`."""
    writer = rejects(_new_files(spark, stage, max_files)).writeStream.format("parquet")
    writer = writer.option("path", sink).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()

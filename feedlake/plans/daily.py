"""Daily sums of a feed table, kept in a table of their own: only days that change are summed again."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake import files
from feedlake.operators.ranges import day_range
from feedlake.plans.swaps import files_with, rows_of, swap_files, table_location
from feedlake.plans.tables import (
    FeedTable,
    add_partitions,
    arranged,
    drop_emptied,
    finish_replacements,
    insert,
)
from feedlake.schema import COUNT_COLUMNS, TYPED_SCHEMA, YEAR_COLUMN

# Readers pass over names that begin with an underscore.
PENDING = "_pending"
READY = "_ready"


@dataclass(frozen=True)
class DailySums:
    """The table `name` has a row per day and value of the columns `by` of the table `of`.

    Its columns are `date`, those of `by`, `n_rows`, the sums of the count columns, and `date_year`,
    which it is partitioned by. Rows without a date belong to no day and are not in it.
    """

    name: str
    of: FeedTable
    by: tuple[str, ...] = ("plaza_id", "direction")

    def __post_init__(self):
        strange = [c for c in self.by if c not in TYPED_SCHEMA.names or c == "date"]
        if strange or set(self.by) & set(COUNT_COLUMNS):
            raise ValueError(f"no daily sums by {self.by}")

    @property
    def partition_column(self) -> str:
        return YEAR_COLUMN

    @property
    def partition_columns(self) -> list[str]:
        return [YEAR_COLUMN]


def daily_sums(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows and sums per day and `by`; added up in the map tasks before they are shuffled."""
    sums = [F.sum(c).alias(c) for c in COUNT_COLUMNS]
    dated = rows.where(F.col("date").isNotNull())
    return dated.groupBy("date", *by).agg(F.count("*").alias("n_rows"), *sums)


def create_sums(spark: SparkSession, sums: DailySums) -> None:
    """Create the table of sums unless it is there, and sum up what its feed table holds.

    A call that was broken off is gone on with by the next.
    """
    kinds = {f.name: f.dataType.simpleString() for f in TYPED_SCHEMA}
    columns = [f"{c} {kinds[c]}" for c in ("date", *sums.by)]
    columns += [f"{c} bigint" for c in ("n_rows", *COUNT_COLUMNS)]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {sums.name} ({', '.join(columns)}, {YEAR_COLUMN} int) "
        f"USING parquet PARTITIONED BY ({YEAR_COLUMN})"
    )
    ready = files.child(spark, table_location(spark, sums.name), READY)
    if files.read_lines(spark, ready) is None:
        refresh_sums(spark, sums)
        files.write_lines(spark, ready, [])


def refresh_sums(
    spark: SparkSession,
    sums: DailySums,
    start: datetime.date | None = None,
    stop: datetime.date | None = None,
) -> int:
    """Sum the days of `[start, stop)` again; returns how many rows of sums they have.

    A bound that is None is left open. Nothing else of the feed table is read. Files of sums without
    a day of the window stay byte for byte. Running it again changes nothing.
    """
    inside = F.coalesce(day_range(start, stop), F.lit(False)) & F.col("date").isNotNull()
    years = F.lit(True)
    if start is not None:
        years = years & (F.col(YEAR_COLUMN) >= start.year)
    if stop is not None:
        last = stop - datetime.timedelta(days=1)
        years = years & (F.col(YEAR_COLUMN) <= last.year)
    return _sum_again(spark, sums, inside, years)


def _sum_again(spark: SparkSession, sums: DailySums, inside: Column, years: Column) -> int:
    """Sum the days `inside` again; `years` holds for all their rows, and prunes partitions."""
    finish_replacements(spark, sums)
    base = spark.table(sums.of.name)
    if sums.of.has_year_column:
        base = base.where(years)
    fresh = daily_sums(base.where(inside), sums.by).withColumn(YEAR_COLUMN, F.year("date"))
    current = spark.table(sums.name)
    touched = files_with(current.where(years).where(inside))
    kept = rows_of(current, touched).where(~inside)
    merged = (
        kept.withColumn("_new", F.lit(False))
        .unionByName(fresh.withColumn("_new", F.lit(True)))
        .hint("rebalance", YEAR_COLUMN)
    )
    counted = Observation()
    ready = merged.observe(
        counted,
        F.count_if("_new").alias("n_rows"),
        F.collect_set(YEAR_COLUMN).alias("years"),
    ).sortWithinPartitions(YEAR_COLUMN, "date", *sums.by)
    location = table_location(spark, sums.name)
    swap_files(spark, location, touched, ready.select(*current.columns), sums.partition_columns)
    add_partitions(spark, sums, [(year,) for year in counted.get["years"]])
    drop_emptied(spark, sums, location, touched)
    spark.catalog.refreshTable(sums.name)
    return counted.get["n_rows"]


def _note(spark: SparkSession, sums: DailySums, start=None, stop=None) -> str:
    """Note, before the feed table is changed, which days will have to be summed again."""
    path = files.child(
        spark, table_location(spark, sums.name), f"{PENDING}/{uuid.uuid4().hex}"
    )
    files.write_lines(spark, path, [day.isoformat() if day else "" for day in (start, stop)])
    return path


def finish_sums(spark: SparkSession, sums: DailySums) -> int:
    """Sum the days again of changes that were broken off; returns how many changes there were.

    `append_summed` and `summed_again` do so first.
    """
    folder = files.child(spark, table_location(spark, sums.name), PENDING)
    noted = [name for name in files.names_in(spark, folder) if not name.startswith(".")]
    if noted and not sums.of.is_iceberg:
        finish_replacements(spark, sums.of)
    for name in noted:
        path = files.child(spark, folder, name)
        lines = files.read_lines(spark, path)
        window = [datetime.date.fromisoformat(line) if line else None for line in lines]
        refresh_sums(spark, sums, *window)
        files.delete(spark, path)
    return len(noted)


@contextmanager
def summed_again(
    spark: SparkSession,
    sums: DailySums,
    start: datetime.date | None = None,
    stop: datetime.date | None = None,
) -> Iterator[None]:
    """Around a change of the feed table's days `[start, stop)`, which are then summed again.

    The window is noted before the change. If the change or the sums are broken off, the note stays,
    and whoever calls next, or `finish_sums`, sums these days again: sums are late, never wrong for
    good. Only one writer at a time, as for the feed table.
    """
    finish_sums(spark, sums)
    path = _note(spark, sums, start, stop)
    yield
    refresh_sums(spark, sums, start, stop)
    files.delete(spark, path)


def append_summed(spark: SparkSession, sums: DailySums, rows: DataFrame) -> int:
    """Append typed rows to the feed table, and sum the days again that they are of.

    The days are seen by the stage that writes, so the rows are read once. Of an append that was
    broken off they are not known, and all days are summed again. Returns how many rows there were.
    """
    finish_sums(spark, sums)
    path = _note(spark, sums)
    counted = Observation()
    ready = arranged(sums.of, rows).observe(
        counted, F.count("*").alias("n_rows"), F.collect_set("date").alias("days")
    )
    insert(spark, sums.of, ready)
    days = sorted(counted.get["days"])  # one per day at most
    if days:
        held = F.col(YEAR_COLUMN).isin(sorted({day.year for day in days}))
        inside = F.coalesce(F.col("date").isin(days), F.lit(False))
        _sum_again(spark, sums, inside, held)
    files.delete(spark, path)
    return counted.get["n_rows"]

"""Feed tables: create if absent, append by name, replace a window, read a window."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake import files
from feedlake.operators.ranges import day_range, in_window
from feedlake.plans.swaps import (
    files_with,
    finish_swaps,
    partition_of,
    rows_of,
    swap_files,
    table_location,
)
from feedlake.schema import BATCH_COLUMN, TYPED_SCHEMA, YEAR_COLUMN


@dataclass(frozen=True)
class FeedTable:
    """A table of typed feed rows, partitioned by day or by year of its `date` column.

    Parquet tables have no year transform, so there a `date_year` column carries the year.
    `provider="iceberg"` uses Iceberg's own transform and writes; its jar must be on the class
    path. That branch is untested but for its DDL text. A `batched` table also has the number of
    the batch that brought each row, as a second partition column: see `streaming.incremental`.
    """

    name: str
    by: str = "day"
    provider: str = "parquet"
    batched: bool = False

    def __post_init__(self):
        if self.by not in ("day", "year"):
            raise ValueError(f"a feed table is partitioned by day or by year, not by {self.by}")
        if self.batched and self.is_iceberg:
            raise ValueError("a batched table is a Parquet table")

    @property
    def is_iceberg(self) -> bool:
        return self.provider == "iceberg"

    @property
    def has_year_column(self) -> bool:
        return self.by == "year" and not self.is_iceberg

    @property
    def partition_column(self) -> str:
        return YEAR_COLUMN if self.has_year_column else "date"

    @property
    def partition_columns(self) -> list[str]:
        return [self.partition_column, *([BATCH_COLUMN] if self.batched else [])]


def create_statement(table: FeedTable) -> str:
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in TYPED_SCHEMA]
    if table.has_year_column:
        columns.append(f"{YEAR_COLUMN} int")
    if table.batched:
        columns.append(f"{BATCH_COLUMN} bigint")
    by_year = table.by == "year" and table.is_iceberg
    split = "years(date)" if by_year else ", ".join(table.partition_columns)
    return (
        f"CREATE TABLE IF NOT EXISTS {table.name} ({', '.join(columns)}) "
        f"USING {table.provider} PARTITIONED BY ({split})"
    )


def create_if_absent(spark: SparkSession, table: FeedTable) -> None:
    """Create the table unless it is there; a table with another partitioning is refused."""
    spark.sql(create_statement(table))
    if table.is_iceberg:
        return
    found = [c.name for c in spark.catalog.listColumns(table.name) if c.isPartition]
    if found != table.partition_columns:
        raise ValueError(f"{table.name} is partitioned by {found}, not {table.partition_columns}")


def create_raw(df: DataFrame, name: str, provider: str = "parquet") -> None:
    """Create a table from a DataFrame as it is; fails if the table exists."""
    df.writeTo(name).using(provider).create()


def arranged(table: FeedTable, rows: DataFrame) -> DataFrame:
    """Rows shuffled so that a partition is written by few tasks, and a big one by several.

    A rebalance, unlike a repartition by the same column, lets Spark cut a day or year that
    holds much of the data into pieces of the advisory size and merge small ones. A year is dealt
    by month, so that the files of a large year hold few months each, and replacing days touches
    few files. An Iceberg table asks Spark for its own shuffle and order, so its rows are left as
    they are.
    """
    if table.is_iceberg:
        return rows
    if not table.has_year_column:
        return rows.hint("rebalance", table.partition_column)
    dated = rows.withColumn(YEAR_COLUMN, F.year("date"))
    by_month = dated.withColumn("_month", F.trunc("date", "month"))
    return by_month.hint("rebalance", YEAR_COLUMN, "_month").drop("_month")


def sorted_for_write(table: FeedTable, rows: DataFrame) -> DataFrame:
    """Sort inside tasks by day, so that a page of a year's file covers few days."""
    if table.is_iceberg:
        return rows
    return rows.sortWithinPartitions(*dict.fromkeys([*table.partition_columns, "date"]))


def append(spark: SparkSession, table: FeedTable, rows: DataFrame) -> int:
    """Append typed rows by column name; returns how many. Appending twice doubles the rows.

    A missing column becomes NULL, a column the table lacks is an error.
    """
    counted = Observation()
    # counted after the shuffle, in the stage that writes: a task that runs again counts once
    # (Iceberg shuffles later, so there a lost executor can raise the number reported)
    ready = arranged(table, rows).observe(counted, F.count("*").alias("n_rows"))
    insert(spark, table, ready)
    return counted.get["n_rows"]


def insert(spark: SparkSession, table: FeedTable, ready: DataFrame) -> None:
    ready = sorted_for_write(table, ready)
    if table.is_iceberg:
        ready.writeTo(table.name).append()
    else:
        spark.sql(f"INSERT INTO {table.name} BY NAME SELECT * FROM {{ready}}", ready=ready)


def read_window(
    spark: SparkSession,
    table: FeedTable,
    start: datetime.date | None,
    stop: datetime.date | None = None,
) -> DataFrame:
    """Rows of the window; on a year column the years are bounded too, so partitions prune."""
    rows = in_window(spark.table(table.name), start, stop)
    if not table.has_year_column:
        return rows
    if start is not None:
        rows = rows.where(F.col(YEAR_COLUMN) >= start.year)
    if stop is not None:
        last = stop - datetime.timedelta(days=1)
        rows = rows.where(F.col(YEAR_COLUMN) <= last.year)
    return rows.drop(YEAR_COLUMN)


def replace_window(
    spark: SparkSession,
    table: FeedTable,
    rows: DataFrame,
    start: datetime.date,
    stop: datetime.date | None = None,
) -> int:
    """Make the table's rows of `[start, stop)` those of `rows` in it; returns how many.

    Running it again changes nothing. Days of the window without new rows end up empty; without a
    `stop` the window has no end. Rows without a date belong to no window and are not loaded. Of a
    Parquet table by year only the files that hold rows of the window are written again, without
    those; all others stay as they are.
    """
    return replace_counted(spark, table, rows, start, stop)["n_rows"]


def replace_counted(
    spark: SparkSession,
    table: FeedTable,
    rows: DataFrame,
    start: datetime.date,
    stop: datetime.date | None = None,
    wanted: Column | None = None,
    metrics: dict[str, Column] | None = None,
) -> dict:
    """`replace_window` with those of `rows` for which `wanted` holds.

    Besides `n_rows`, the rows loaded, it returns `metrics`, aggregates over all of `rows`. They are
    taken after the shuffle, in the stage that writes: a task that runs again counts once. (The
    Iceberg branch is untested, and there a lost executor can raise the numbers.)
    """
    if stop is not None and stop <= start:
        raise ValueError(f"no days from {start} to {stop}")
    if table.batched:
        raise ValueError(f"{table.name} is loaded in batches; its windows cannot be replaced")
    inside = F.coalesce(day_range(start, stop), F.lit(False))
    new = rows.withColumn("_new", inside if wanted is None else inside & wanted)
    asked = {"n_rows": F.count_if("_new"), **(metrics or {})}
    if table.is_iceberg:
        counted = Observation()
        ready = _observed(arranged(table, new), counted, asked).where("_new")
        ready = sorted_for_write(table, ready.select(*TYPED_SCHEMA.names))
        ready.writeTo(table.name).overwrite(day_range(start, stop))
        return counted.get
    require_managed(spark, table)
    if table.by == "day":
        return _replace_days(spark, table, new, asked, start, stop)
    return _replace_in_years(spark, table, new, asked, start, stop)


def _observed(rows: DataFrame, counted: Observation, metrics: dict[str, Column]) -> DataFrame:
    return rows.observe(counted, *[m.alias(name) for name, m in metrics.items()])


def require_managed(spark: SparkSession, table: FeedTable) -> None:
    # dropping a partition of an external table would leave its files for a later append to find
    if spark.catalog.getTable(table.name).tableType != "MANAGED":
        raise ValueError(f"{table.name} is not a managed table; its rows cannot be replaced")


def _replace_days(spark, table, new, metrics, start, stop) -> dict:
    counted = Observation()
    days = F.collect_set(F.when(F.col("_new"), F.col("date")))
    ready = _observed(arranged(table, new), counted, {**metrics, "_days": days}).where("_new")
    overwrite_files(spark, table, ready)
    result = counted.get
    written = set(result.pop("_days"))
    add_partitions(spark, table, [(day,) for day in written])
    names = {day.isoformat() for day in written}
    end = stop.isoformat() if stop else "9999-99"
    existing = partition_values(spark, table)
    stale = [d for d, *_ in existing if start.isoformat() <= d < end and d not in names]
    drop_partitions(spark, table, [(day,) for day in stale])
    return result


def _replace_in_years(spark, table, new, metrics, start, stop) -> dict:
    """The files that hold rows of the window are written again without these, and the new rows."""
    finish_replacements(spark, table)
    current = spark.table(table.name).where(F.col(YEAR_COLUMN) >= start.year)
    if stop is not None:
        last = stop - datetime.timedelta(days=1)
        current = current.where(F.col(YEAR_COLUMN) <= last.year)
    inside = F.coalesce(day_range(start, stop), F.lit(False))
    touched = files_with(current.where(inside))
    kept = rows_of(current, touched).where(~inside)
    return rewrite(spark, table, touched, kept, new, metrics)


def rewrite(
    spark: SparkSession,
    table: FeedTable,
    touched: list[str],
    kept: DataFrame,
    new: DataFrame,
    metrics: dict[str, Column],
) -> dict:
    """Let the files `touched` go, for their rows `kept` and those rows of `new` with `_new` set.

    Returns `metrics`, aggregates over all of `new`, taken in the stage that writes. Partitions
    that are new are added to the catalog by name, and those left without a file are dropped.
    """
    column, stays = table.partition_column, F.col("_kept")
    merged = (
        kept.select(*TYPED_SCHEMA.names)
        .withColumn("_kept", F.lit(True))
        .unionByName(new.withColumn("_kept", F.lit(False)), allowMissingColumns=True)
    )
    # a kept row has nulls for the marks of new ones, which no aggregate counts; a null partition
    # is noted as such
    written = F.collect_set(F.when(stays | F.col("_new"), F.struct(F.col(column).alias("value"))))
    counted = Observation()
    ready = _observed(arranged(table, merged), counted, {**metrics, "_written": written})
    ready = sorted_for_write(table, ready.where(stays | F.col("_new")))
    location = table_location(spark, table.name)
    columns = [F.col(f.name).cast(f.dataType) for f in spark.table(table.name).schema]
    swap_files(spark, location, touched, ready.select(*columns), table.partition_columns)
    result = counted.get
    add_partitions(spark, table, [(row["value"],) for row in result.pop("_written")])
    drop_emptied(spark, table, location, touched)
    spark.catalog.refreshTable(table.name)
    return result


def drop_emptied(spark, table, location, gone: Iterable[str]) -> None:
    """Drop the partitions of files that went, where no file is left."""
    column = table.partition_column
    values = {partition_of(path, column) for path in gone} - {None}
    emptied = [
        value
        for value in values
        if not files.names_in(spark, files.child(spark, location, f"{column}={value}"))
    ]
    drop_partitions(spark, table, [(value,) for value in emptied])


def finish_replacements(spark: SparkSession, table: FeedTable) -> None:
    """Bring a replacement that was broken off while files were swapped to its end.

    Every replacement and upsert does so first. Partitions that it had not told the catalog of are
    found by listing, which is needed after such a break only.
    """
    if finish_swaps(spark, table_location(spark, table.name)):
        spark.catalog.recoverPartitions(table.name)
        spark.catalog.refreshTable(table.name)


def overwrite_files(spark: SparkSession, table: FeedTable, ready: DataFrame) -> None:
    """Overwrite exactly the partitions that `ready` has rows for, whatever the session's mode.

    An insert into a table takes the mode from the session; a write of files takes it as an option
    of its own. So the files are written where the table keeps them, and the caller tells the
    catalog which partitions these are: nothing lists the table.
    """
    columns = [F.col(f.name).cast(f.dataType) for f in spark.table(table.name).schema]
    rows = sorted_for_write(table, ready).select(*columns)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*table.partition_columns).parquet(table_location(spark, table.name))


# Partitions in one statement to the catalog.
_AT_ONCE = 500


def _specs(table: FeedTable, partitions: list[tuple]) -> Iterable[str]:
    """Partition specs in SQL, as many at a time as one statement takes."""

    def value(v) -> str:
        return "null" if v is None or v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'"

    specs = [
        "PARTITION ("
        + ", ".join(f"{c}={value(v)}" for c, v in zip(table.partition_columns, p, strict=True))
        + ")"
        for p in partitions
    ]
    for first in range(0, len(specs), _AT_ONCE):
        yield " ".join(specs[first : first + _AT_ONCE]), ", ".join(specs[first : first + _AT_ONCE])


def add_partitions(spark: SparkSession, table: FeedTable, partitions: list[tuple]) -> None:
    """Tell the catalog of written partitions, by name, and readers of their new files."""
    for spaced, _ in _specs(table, partitions):
        spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {spaced}")
    spark.catalog.refreshTable(table.name)


def drop_partitions(spark: SparkSession, table: FeedTable, partitions: list[tuple]) -> None:
    for _, listed in _specs(table, partitions):
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {listed}")


def partition_values(spark: SparkSession, table: FeedTable) -> list[tuple[str, ...]]:
    """Values of the partition columns as text, from the catalog: one per partition."""
    shown = spark.sql(f"SHOW PARTITIONS {table.name}").collect()
    return [tuple(x.split("=", 1)[1] for x in row.partition.split("/")) for row in shown]

"""Copy-on-write: some files of a Parquet table are replaced by new ones, the others stay.

The new files are written in a folder beside the partitions that no reader looks into. Then a list
of the files to go is put there, in one piece, and from then on the swap is decided: new files are
moved to their partitions, old ones deleted. Either can be done again, so a swap that was broken off
is brought to its end by whoever changes the table next; one without its list never happened.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import files

# Readers pass over names that begin with an underscore.
SWAPS = "_swaps"
GOING = "_going"


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'")
    return described.select("data_type").first()[0]


def files_with(rows: DataFrame) -> list[str]:
    """Names of the files that `rows`, a filtered table, has rows in; statistics skip most."""
    return [row[0] for row in rows.select("_metadata.file_path").distinct().collect()]


def rows_of(rows: DataFrame, paths: list[str]) -> DataFrame:
    """Rows of the named files; no other file is opened."""
    return rows.where(F.col("_metadata.file_path").isin(paths))


def swap_files(
    spark: SparkSession, location: str, going: list[str], ready: DataFrame, by: list[str]
) -> None:
    """Write `ready` into partitions `by` below `location`, and let the files `going` go."""
    staged = files.child(spark, location, f"{SWAPS}/{uuid.uuid4().hex}")
    ready.write.partitionBy(*by).parquet(unquote(staged))
    files.write_lines(spark, files.child(spark, staged, GOING), going)
    _finish(spark, location, staged)


def finish_swaps(spark: SparkSession, location: str) -> int:
    """Bring decided swaps to their end; returns how many there were.

    Only one writer may change a table at a time, as with any Parquet table.
    """
    folder, finished = files.child(spark, location, SWAPS), 0
    for name in files.names_in(spark, folder):
        staged = files.child(spark, folder, name)
        if files.read_lines(spark, files.child(spark, staged, GOING)) is not None:
            _finish(spark, location, staged)
            finished += 1
    return finished


def _finish(spark: SparkSession, location: str, staged: str) -> None:
    going = files.read_lines(spark, files.child(spark, staged, GOING))
    for path in files.files_below(spark, staged):
        inner = unquote(path.split(f"/{SWAPS}/", 1)[1].split("/", 1)[1])
        partition, _, name = inner.rpartition("/")
        if partition and not name.startswith(("_", ".")):
            files.move(spark, path, files.child(spark, location, partition))
    for path in going:
        files.delete(spark, path)
    files.delete(spark, staged)


def partition_of(path: str, column: str) -> str | None:
    """The value that a file's path gives to a partition column."""
    found = re.search(rf"/{re.escape(column)}=([^/]*)/", path)
    return found and unquote(found[1])

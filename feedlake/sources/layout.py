"""Row offsets over a DataFrame: rows written once in a total order, with an index of offsets.

Limit and offset need a total order. A global `row_number()` would put every row through one
task, so the rows are range-partitioned by the sort key, sorted inside each partition and
written; a row's offset is then the rows in the files before its file plus its place in the file.
A row is written as one struct, so that no name of the layout can meet one of its columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from feedlake.workspace import settle

# Rows that a range, and so a file, should hold where the session's shuffle partitions would
# make them larger.
ROWS_PER_RANGE = 10_000_000


@dataclass(frozen=True)
class Layout:
    """A written layout: `rows/` in order, `files/` with the offset at which each file starts."""

    path: str
    schema: StructType

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def files_path(self) -> str:
        return f"{self.path}/files"

    @property
    def written_schema(self) -> StructType:
        return StructType([StructField("row", self.schema)]).add("part", "integer")


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; values that have none of their own, such as maps, go as JSON."""
    parts = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        plain = "map<" not in kind and "variant" not in kind
        parts.append(column if plain else F.to_json(F.struct(column)))
    return F.xxhash64(*parts)


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """`key, tie, row`: what to order by, a hash for rows with equal keys, and the row."""
    return df.select(
        F.struct(*[F.col(f"`{k}`") for k in keys]).alias("key"),
        row_hash(df).alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
    )


def write_layout(df: DataFrame, keys: list[str], path: str, settled: bool = False) -> Layout:
    """Write `df` to `path` ordered by `keys`.

    Rows with equal keys are ordered by a hash of the row and then by where they were read, so
    that a key held by a large part of the rows, even one row repeated, is still cut into many
    ranges. Where a row is read must be the same when a task runs again, so the input is written
    first, unless it is `settled`: read from files with no shuffle since.
    """
    spark = df.sparkSession
    layout = Layout(path, df.schema)
    _write_rows(df if settled else settle(df, "input"), keys, layout)
    _write_index(spark, layout)
    return layout


def _write_rows(df: DataFrame, keys: list[str], layout: Layout) -> None:
    order = ["key", "tie", "place"]
    marked = keyed(df, keys).withColumn("place", F.monotonically_increasing_id())
    # counted from file footers, as the input is in files
    ranges = math.ceil(df.count() / ROWS_PER_RANGE)
    usual = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sized = usual.isdigit() and ranges > int(usual)
    ranged = marked.repartitionByRange(*([ranges] if sized else []), *order)
    ordered = ranged.withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *order)
    ordered.select("row", "part").write.partitionBy("part").parquet(layout.rows_path)


def _write_index(spark: SparkSession, layout: Layout) -> None:
    """Write where each file starts: a running total over one row per file."""
    written = _written(spark, layout)
    # ...c<file within partition>.<codec>.parquet, where a partition may be cut into several files
    number = F.regexp_extract("file", r"[.-]c(\d+)(?:\.\w+)*$", 1).cast("int")
    before = W.orderBy("part", "chunk").rowsBetween(W.unboundedPreceding, -1)
    (
        written.groupBy("part", F.col("_metadata.file_name").alias("file"))
        .agg(F.count("*").alias("n_rows"))
        .withColumn("chunk", number)
        .withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
        .select("part", "file", "first_row", "n_rows")
        .write.parquet(layout.files_path)
    )


def _written(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(layout.written_schema).parquet(layout.rows_path)


def _located(rows: DataFrame, files: DataFrame) -> DataFrame:
    """`row, at`: rows and the offsets that the index gives them."""
    placed = rows.select(
        "part",
        "row",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("index"),
    )
    return placed.join(files.select("part", "file", "first_row"), ["part", "file"]).select(
        "row", (F.col("first_row") + F.col("index")).alias("at")
    )


def with_offsets(spark: SparkSession, layout: Layout, name: str = "row_offset") -> DataFrame:
    """Every row of the layout with its offset, counted from 0, in a column of this name."""
    if name.lower() in (c.lower() for c in layout.schema.names):
        raise ValueError(f"the rows have a column {name} already")
    located = _located(_written(spark, layout), spark.read.parquet(layout.files_path))
    return located.select("row.*", F.col("at").alias(name))


def rows_between(spark: SparkSession, layout: Layout, lo: int, hi: int) -> DataFrame:
    """Rows with offsets in `[lo, hi)`, in order; only ranges that hold some are read."""
    files = spark.read.parquet(layout.files_path)
    wanted = files.where((F.col("first_row") < hi) & (F.col("first_row") + F.col("n_rows") > lo))
    # the ranges are in order, so those wanted lie between two numbers
    first, last = wanted.agg(F.min("part"), F.max("part")).first()
    rows = _written(spark, layout).where(F.col("part").between(first, last))
    located = _located(rows, wanted).where((F.col("at") >= lo) & (F.col("at") < hi))
    return located.orderBy("at").select("row.*")

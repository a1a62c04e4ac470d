"""Upserts: rows of a load take the place of the table's rows with the same key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.plans.swaps import rows_of
from feedlake.plans.tables import FeedTable, finish_replacements, require_managed, rewrite
from feedlake.schema import KEY_COLUMNS, TYPED_SCHEMA, YEAR_COLUMN
from feedlake.workspace import settle


@dataclass(frozen=True)
class UpsertReport:
    """`n_rows` were written, one per key of the load; `n_replaced` rows of the table gave way."""

    n_rows: int
    n_replaced: int


def newest_per_key(rows: DataFrame, newest: str | None = None) -> DataFrame:
    """One typed row per key: of several the one with the largest `newest`.

    A null `newest` is older than any other. Of equally new ones the largest counts win, so that the
    choice does not depend on the order of rows. Keys that are null are equal. Rows are compared in
    the map tasks before they are shuffled, so a key that repeats very often costs no more.
    """
    counts = [c for c in TYPED_SCHEMA.names if c not in KEY_COLUMNS]
    order = [F.col(newest).alias("_newest")] if newest else []
    best = F.max(F.struct(*order, *counts)).alias("_best")
    chosen = rows.groupBy(*KEY_COLUMNS).agg(best)
    return chosen.select(*KEY_COLUMNS, *(f"_best.{c}" for c in counts)).select(*TYPED_SCHEMA.names)


def _key() -> Column:
    """The key as one value; as parts of a struct, nulls are equal."""
    return F.struct(*KEY_COLUMNS).alias("_key")


def upsert(
    spark: SparkSession, table: FeedTable, rows: DataFrame, newest: str | None = None
) -> UpsertReport:
    """Put the newest of `rows` per key into the table, instead of all its rows with that key.

    Running it again changes nothing. Files that hold a key of `rows` are written again without
    those rows; all others stay as they are, and only partitions of the load's days are looked at.
    A table that is loaded in batches is refused.
    """
    if table.is_iceberg:
        raise ValueError("Iceberg has MERGE INTO for this")
    if table.batched:
        raise ValueError(f"{table.name} is loaded in batches; its rows cannot be replaced")
    require_managed(spark, table)
    finish_replacements(spark, table)
    new = settle(newest_per_key(rows, newest), "upsert")
    first, last, undated = new.agg(
        F.min("date"), F.max("date"), F.coalesce(F.max(F.col("date").isNull()), F.lit(False))
    ).first()
    keys = new.select(_key())
    whole = spark.table(table.name)
    # bounds that prune partitions; the join decides
    dated = F.col("date").between(first, last)
    near = dated | F.col("date").isNull() if undated else dated
    if table.has_year_column and first is not None:
        years = F.col(YEAR_COLUMN).between(first.year, last.year)
        near = near & (years | F.col(YEAR_COLUMN).isNull() if undated else years)
    hit = whole.where(near).select("_metadata.file_path", _key()).join(keys, "_key", "left_semi")
    per_file = hit.groupBy("file_path").agg(F.count("*").alias("n"))
    touched = {r.file_path: r.n for r in per_file.collect()}
    kept = rows_of(whole, [*touched]).withColumn("_key", _key()).join(keys, "_key", "left_anti")
    marked = new.withColumn("_new", F.lit(True))
    counted = rewrite(
        spark, table, [*touched], kept.drop("_key"), marked, {"n_rows": F.count_if("_new")}
    )
    return UpsertReport(counted["n_rows"], sum(touched.values()))

"""Limit and offset over a DataFrame, and pages of a number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.sources.layout import keyed, rows_between, write_layout
from feedlake.workspace import scratch_path


def limit_offset(df: DataFrame, keys: list[str], limit: int, offset: int = 0) -> DataFrame:
    """Rows `[offset, offset + limit)` of `df` in the order of `keys`, then of a hash of the row.

    A sorted limit: each task keeps its first `offset + limit` rows and one task merges them. For
    a depth at which that is too many, call `deep_limit_offset`, which gives the same rows in the
    same order.
    """
    rows = keyed(df, keys).orderBy("key", "tie")
    return rows.offset(offset).limit(limit).select("row.*")


def deep_limit_offset(
    df: DataFrame, keys: list[str], limit: int, offset: int, settled: bool = False
) -> DataFrame:
    """`limit_offset` for any depth: writes `df` once in order and reads the ranges asked for.

    See `write_layout` for `settled`. To ask for many pages, write the layout once and use
    `rows_between`.
    """
    layout = write_layout(df, keys, scratch_path(df.sparkSession, "layout"), settled=settled)
    return rows_between(df.sparkSession, layout, offset, offset + limit)


def page_counts(df: DataFrame, page_size: int) -> DataFrame:
    """`page, n_rows` of `df` cut into pages: all but the last are full, so one count tells."""
    total = df.count()
    pages = df.sparkSession.range(-(-total // page_size)).withColumnRenamed("id", "page")
    left = F.lit(total) - F.col("page") * page_size
    return pages.select("page", F.least(left, F.lit(page_size)).cast("long").alias("n_rows"))

"""Line dedup by site-relative frequency (5), with DataFrame functions only.

For each host, the pages that contain a line are divided by the pages of the host; lines above a
ratio are boilerplate and are dropped from all of the host's pages. A page that a host holds several
times is one page, so that copies of a document do not turn its own lines into boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.bitmap import text_hash
from feedlake.workspace import settle

# A line is boilerplate if more than this share of its host's pages contain it, and this many.
MOST_PERCENT = 10
LEAST_PAGES = 5

BLANK = " \t\r\x0b\x0c"


def _line_key(line: Column) -> Column:
    """What stands for a line, without blanks around it; null for a blank line."""
    bare = F.trim(line, F.lit(BLANK))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    most_percent: int = MOST_PERCENT,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """`host, lines`: for each host that has any, the hashes of its boilerplate lines.

    A page counts a line once, however often it repeats it. Rows without a host are one host, with
    a null name. Only hashes are shuffled: each page's lines, once per distinct page and host.
    """
    named = docs.select(F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    keys = F.transform(F.split("text", "\n", -1), _line_key)
    pages = named.select("host", text_hash().alias("page"), F.array_distinct(keys).alias("keys"))
    # the page's hash decides its lines, so which copy's array stays makes no difference
    pages = pages.groupBy("host", "page").agg(F.first("keys").alias("keys"))
    pages = settle(pages, "pages")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    lines = (
        pages.select("host", F.explode("keys").alias("line"))
        .where("line is not null")
        .groupBy("host", "line")
        .agg(F.count("*").alias("holding"))
        .where(F.col("holding") >= least_pages)
    )
    often = lines.join(totals.toDF("of_host", "pages"), F.col("host").eqNullSafe(F.col("of_host")))
    often = often.where(100 * F.col("holding") > most_percent * F.col("pages"))
    return often.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def without_boilerplate(
    docs: DataFrame,
    host: str = "source",
    most_percent: int = MOST_PERCENT,
    least_pages: int = LEAST_PAGES,
    dropped: str = "n_dropped",
) -> DataFrame:
    """`docs` with boilerplate lines taken out of `text`, and how many lines were, as `dropped`.

    The kept lines stay as they are and in order; blank lines stay. A null text stays null. All
    other columns stay, whatever they are called; one called as `dropped` is replaced. Repeated rows
    are each returned.

    A host's boilerplate is a short list: with at most so many lines a page, no more than that over
    the ratio can exceed it. The lists are written first, so Spark knows their size when it chooses
    between a broadcast and a shuffle by host, whose skewed partitions it splits.
    """
    found = settle(boilerplate(docs, host, most_percent, least_pages), "boilerplate")
    found = found.toDF("of_host", "listed")
    kept_names = [c for c in docs.columns if c.lower() != dropped.lower()]
    row = F.col("row")
    joined = docs.select(F.struct(*(f"`{c}`" for c in kept_names)).alias("row")).join(
        found, row[host].eqNullSafe(F.col("of_host")), "left"
    )
    lines = F.split(row["text"], "\n", -1)
    listed = F.coalesce("listed", F.array().cast("array<bigint>"))
    stays = F.filter(
        lines, lambda line: ~F.coalesce(F.array_contains(listed, _line_key(line)), F.lit(False))
    )
    kept = F.when(F.col("listed").isNull(), lines).otherwise(stays)
    columns = [
        (F.array_join(kept, "\n") if c == "text" else row[c]).alias(c) for c in kept_names
    ]
    n_dropped = F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long")
    # as one struct, in which no name can stand for another column
    return joined.select(F.struct(*columns, n_dropped.alias(dropped)).alias("row")).select("row.*")

"""Traffic feeds derived from the given tables, in the all-text form they have on the wire."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import in_window

MIDNIGHT = "T00:00:00.000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wire_date(moment: str):
    return F.concat(F.to_date(moment).cast("string"), F.lit(MIDNIGHT))


def plaza(number: str):
    return (21 + F.col(number) % 10).cast("string")


def direction(number: str):
    return F.when(F.col(number) % 2 == 0, "I").otherwise("O")


def month_feed(spark: SparkSession, sf_dir: str, start=None, stop=None) -> DataFrame:
    """One row per plaza, day, hour and direction of `events` in the window.

    As with a request to the feed, the window is applied where the rows are.
    """
    passes = F.col("event_type").isin("view", "click")
    return (
        in_window(table(spark, sf_dir, "events"), start, stop, "ts")
        .groupBy(
            plaza("user_id").alias("plaza_id"),
            F.to_date("ts").alias("day"),
            F.hour("ts").alias("hour"),
            direction("event_id").alias("direction"),
        )
        .agg(F.count_if(passes).alias("passes"), F.count_if(~passes).alias("tolls"))
        .select(
            "plaza_id",
            wire_date("day").alias("date"),
            F.col("hour").cast("string").alias("hour"),
            "direction",
            F.col("passes").cast("string").alias("vehicles_e_zpass"),
            F.col("tolls").cast("string").alias("vehicles_vtoll"),
        )
    )


def _from_lineitem(lineitem: DataFrame, tolls) -> DataFrame:
    return lineitem.select(
        plaza("l_suppkey").alias("plaza_id"),
        wire_date("l_shipdate").alias("date"),
        (F.col("l_partkey") % 24).cast("string").alias("hour"),
        direction("l_orderkey").alias("direction"),
        F.col("l_quantity").cast("int").cast("string").alias("vehicles_e_zpass"),
        tolls.alias("vehicles_vtoll"),
    )


def _tolls():
    return F.round(F.col("l_discount") * 100).cast("int").cast("string")


def years_feed(spark: SparkSession, sf_dir: str, start=None, stop=None) -> DataFrame:
    """One row per row of `lineitem` in the window; its keys repeat.

    As with a request to the feed, the window is applied where the rows are, before they
    become text.
    """
    lineitem = in_window(table(spark, sf_dir, "lineitem"), start, stop, "l_shipdate")
    return _from_lineitem(lineitem, _tolls())


def years_feed_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`years_feed` in which some toll counts read `n/a`."""
    unknown = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 97 == 0
    tolls = F.when(unknown, "n/a").otherwise(_tolls())
    return _from_lineitem(table(spark, sf_dir, "lineitem"), tolls)

"""URL filters by a temporal list join (6), with DataFrame functions only.

A list is a log of dated entries, `pattern, listed_on, action`: from that day on the pattern is
blocked or allowed, or removed from the list. A pattern is a host, which covers its subdomains too.
Entries become intervals of days on which they hold, and each capture is evaluated against those
that hold on the day it was fetched; the longest such pattern decides.

As-of by equality: intervals are cut at the bounds of `SLOT_DAYS`-day slots, and captures are joined
on pattern and slot, so that of a pattern with a long history only the days around a capture meet
it. The number of pieces follows the intervals' length in slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.workspace import settle

SLOT_DAYS = 64


def host_of(url: str = "url") -> Column:
    """The lower-case host of a URL, without user, port and final dot; null if there is none."""
    host = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(host), r"\.$", ""), F.lit(""))


def covering(host: Column) -> Column:
    """The host and all domains above it, down to its last label, longest first."""
    labels = F.split(host, r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda first: F.array_join(F.slice(labels, first, F.size(labels)), "."),
    )
    return F.when(host.isNotNull(), above)


def intervals(entries: DataFrame) -> DataFrame:
    """`pattern, action, first_day, next_day`: the days `[first_day, next_day)` an entry holds.

    An entry holds until the pattern's next one; the last has a null `next_day`. Of several on one
    day the smallest action counts (allow, block, remove). Removals end an interval and make none.
    Entries without pattern, day or action are left out. Patterns are lower-cased.
    """
    clean = entries.select(
        F.lower("pattern").alias("pattern"), F.col("listed_on").cast("date").alias("first_day"),
        "action",
    ).where("pattern is not null and first_day is not null and action is not null")
    daily = clean.groupBy("pattern", "first_day").agg(F.min("action").alias("action"))
    following = F.lead("first_day").over(W.partitionBy("pattern").orderBy("first_day"))
    return (
        daily.withColumn("next_day", following)
        .where("action <> 'remove'")
        .select("pattern", "action", "first_day", "next_day")
    )


def _slot(day: Column) -> Column:
    return F.floor(F.unix_date(day) / SLOT_DAYS)


def filtered_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """`captures` with `host, pattern, action, blocked`: the entry that decides each capture.

    `captures` has `url` and a `fetched_on` date. Without an entry that holds, or without a host or
    a date, pattern and action are null and the capture is not blocked. All other columns stay,
    whatever they are called; ones called like an output column are replaced. Repeated rows are each
    returned.
    """
    held = settle(intervals(entries), "intervals")
    # an open interval ends with the last capture, and none need start before the first
    last = captures.agg(F.max("fetched_on").alias("day")).first().day
    final = F.coalesce(F.date_sub("next_day", 1), F.greatest(F.lit(last), F.col("first_day")))
    slots = F.sequence(_slot(F.col("first_day")), _slot(F.least(final, F.lit(last))))
    pieces = held.where(F.col("first_day") <= F.lit(last)).select(
        "pattern", "action", "first_day", "next_day", F.explode(slots).alias("slot")
    )
    own = {"host", "pattern", "action", "blocked"}
    kept = [c for c in captures.columns if c.lower() not in own]
    # one question per host and day, however many captures ask it
    named = captures.select(
        F.struct(*[f"`{c}`" for c in kept]).alias("row"), host_of().alias("host"), "fetched_on"
    )
    asked = named.where("host is not null and fetched_on is not null")
    asked = asked.select("host", "fetched_on").distinct()
    tried = asked.select(
        "host", "fetched_on", _slot(F.col("fetched_on")).alias("slot"),
        F.explode(covering(F.col("host"))).alias("pattern"),
    )
    answers = (
        tried.join(pieces, ["pattern", "slot"])
        .where(F.col("fetched_on") >= F.col("first_day"))
        .where(F.col("next_day").isNull() | (F.col("fetched_on") < F.col("next_day")))
        .groupBy("host", "fetched_on")
        .agg(F.max_by(F.struct("pattern", "action"), F.length("pattern")).alias("entry"))
        .select(
            F.col("host").alias("of_host"), F.col("fetched_on").alias("of_day"),
            "entry.pattern", "entry.action",
        )
    )
    same = (F.col("host") == F.col("of_host")) & (F.col("fetched_on") == F.col("of_day"))
    return named.join(answers, same, "left").select(
        "row.*",
        "host",
        "pattern",
        "action",
        F.coalesce(F.col("action") == "block", F.lit(False)).alias("blocked"),
    )

"""One query per operator. Each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.functions import load_window, midnight_literal, parse_day
from feedlake.operators import (
    deep_limit_offset,
    drilldown,
    duplicate_keys,
    in_window,
    limit_offset,
    missing_days,
    page_counts,
    per_default_window,
    record_total,
    stage_drift,
    typed_rows,
    weekly_run_dates,
)
from feedlake.plans import (
    DailySums,
    FeedTable,
    LoadReport,
    append,
    append_stage,
    append_summed,
    backfill,
    create_if_absent,
    create_raw,
    create_sums,
    footprint,
    load_feed,
    read_ledger,
    read_window,
    replace_window,
    stage_measure,
    stage_rejects,
    summed_again,
    upsert,
)
from feedlake.sources import (
    decode_json,
    encode_json,
    publish_stage,
    read_published,
    read_stage,
    with_offsets,
    write_layout,
    write_stage,
)
from feedlake.streaming import load_new_files
from feedlake.workspace import scratch_database, scratch_path
from registry.feeds import month_feed, table, years_feed, years_feed_with_gaps

WEEK = (datetime.date(2024, 1, 8), datetime.date(2024, 1, 15))
MONTH = (datetime.date(2024, 1, 1), datetime.date(2024, 2, 1))
ALL_YEARS = (datetime.date(1995, 1, 1), datetime.date(2002, 1, 1))
PAGE_SIZE = 1000


def _sums(rows: DataFrame, *by) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.sum("vehicles_e_zpass").alias("e_zpass"),
        F.sum("vehicles_vtoll").alias("vtoll"),
    )


# --- paged source -------------------------------------------------------------------------


def _event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("date"))


def _pages(spark, rows):
    """Rows of each page in the order of day and id; only what is asked for is laid out."""
    layout = write_layout(rows, ["date", "event_id"], scratch_path(spark, "pages"), settled=True)
    page = F.expr(f"row_offset div {PAGE_SIZE}").alias("page")
    return with_offsets(spark, layout).groupBy(page).agg(
        F.count("*").alias("n_rows"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


def _week_of_events(spark, sf_dir):
    """The week of `events`, bounded where the rows are, as by a request to the feed."""
    return in_window(table(spark, sf_dir, "events"), *WEEK, column="ts")


def paged_scan(spark, sf_dir):
    return _pages(spark, _event_days(spark, sf_dir))


def paged_scan_range(spark, sf_dir):
    week = _week_of_events(spark, sf_dir)
    return _pages(spark, week.select("event_id", F.to_date("ts").alias("date")))


def paged_scan_filter(spark, sf_dir):
    week = _week_of_events(spark, sf_dir).groupBy(F.to_date("ts").alias("date"), "event_type")
    return week.agg(F.count("*").alias("n_rows"))


def page_row_counts(spark, sf_dir):
    return page_counts(table(spark, sf_dir, "events"), PAGE_SIZE)


def limit_offset_top(spark, sf_dir):
    return limit_offset(table(spark, sf_dir, "events"), ["event_id"], 1000, 3000)


def limit_offset_deep(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return deep_limit_offset(orders, ["o_orderkey"], 2000, 12000, settled=True)


# --- stage and storage --------------------------------------------------------------------


def json_stage_scan(spark, sf_dir):
    stage = scratch_path(spark, "stage")
    write_stage(years_feed(spark, sf_dir), stage)
    return read_stage(spark, stage)


def published_stage(spark, sf_dir):
    """Rows of a stage that was opened before it was published again, and those after."""
    stage = scratch_path(spark, "stage")
    publish_stage(years_feed(spark, sf_dir), stage)
    before = read_published(spark, stage).withColumn("number", F.lit(1))
    publish_stage(read_published(spark, stage).where("direction = 'I'"), stage)
    return before.unionByName(read_published(spark, stage).withColumn("number", F.lit(2)))


def json_decode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", decode_json("props", "k int").getField("k").alias("k"))


def json_encode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return encode_json(events.select("event_id", "user_id", "event_type", "props"))


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    years_feed(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def ctas_raw(spark, sf_dir):
    name = f"{scratch_database(spark)}.raw_traffic"
    create_raw(years_feed(spark, sf_dir), name)
    return spark.table(name)


def stored_bytes(spark, sf_dir):
    """The years' feed as JSON, as Parquet and as a table, with the bytes of each."""
    feed = years_feed(spark, sf_dir)
    as_json, as_parquet = scratch_path(spark, "json"), scratch_path(spark, "parquet")
    write_stage(feed, as_json)
    feed.write.mode("overwrite").parquet(as_parquet)
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="year")
    append_stage(spark, as_json, loaded)
    location = spark.sql(f"DESCRIBE EXTENDED {loaded.name}").where("col_name = 'Location'")
    as_table = location.select("data_type").first()[0]
    return footprint(
        spark,
        {
            "json": ("json", as_json),
            "parquet": ("parquet", as_parquet),
            "table": ("parquet", as_table),
        },
    )


def storage_footprint(spark, sf_dir):
    """Rows per format, and whether it takes less than JSON; bytes depend on the writer."""
    found = stored_bytes(spark, sf_dir)
    # one row per format
    bytes_of_json = F.max(F.when(F.col("format") == "json", F.col("n_bytes"))).over(W.partitionBy())
    smaller = (F.col("n_bytes") < bytes_of_json).alias("smaller_than_json")
    return found.select("format", "n_rows", smaller)


# --- typing, ranges and dates -------------------------------------------------------------


def typed_feed(spark, sf_dir):
    return typed_rows(years_feed(spark, sf_dir))


def date_range(spark, sf_dir):
    start, stop = datetime.date(1997, 1, 1), datetime.date(1998, 1, 1)
    return typed_rows(years_feed(spark, sf_dir, start, stop))


def typed_date_range(spark, sf_dir):
    """The range on the typed `date` column itself."""
    start, stop = datetime.date(1997, 1, 1), datetime.date(1998, 1, 1)
    return in_window(typed_rows(years_feed(spark, sf_dir)), start, stop)


def date_range_open(spark, sf_dir):
    return typed_rows(years_feed(spark, sf_dir, datetime.date(2000, 6, 15)))


def iso_literal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("moment"))
    events = table(spark, sf_dir, "events").select(F.col("ts").alias("moment"))
    literal = midnight_literal("moment").alias("literal")
    return orders.unionAll(events).groupBy(literal).agg(F.count("*").alias("n_rows"))


def day_parse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = orders.select(F.date_format("o_orderdate", "yyyy-M-d").alias("text"))
    return text.groupBy(parse_day("text").alias("day")).agg(F.count("*").alias("n_rows"))


def default_window(spark, sf_dir):
    rows = typed_rows(years_feed(spark, sf_dir))
    return per_default_window(
        rows,
        weekly_run_dates(rows),
        ("vehicles_e_zpass", "e_zpass"),
        ("vehicles_vtoll", "vtoll"),
    )


# --- grouped measure ----------------------------------------------------------------------


def _cents():
    return F.round(F.col("c_acctbal") * 100).cast("long")


def drilldown_measure(spark, sf_dir):
    # summed per nation key before the join, so the join sees one row per nation
    per_key = drilldown(table(spark, sf_dir, "customer"), "c_nationkey", _cents(), "cents")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = per_key.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.groupBy("n_name").agg(
        F.sum("cents").alias("cents"), F.sum("n_rows").alias("n_rows")
    )


def measure_stage(spark, sf_dir):
    stage = scratch_path(spark, "measure")
    stage_measure(table(spark, sf_dir, "customer"), "c_nationkey", _cents(), "cents", stage)
    return spark.read.schema("c_nationkey int, cents bigint, n_rows bigint").json(stage)


def response_totals(spark, sf_dir):
    """Responses, one per customer, of one to three records each, and their records."""
    customer = table(spark, sf_dir, "customer")
    record = F.struct(F.col("c_nationkey").alias("nation"), F.lit(1).alias("persons"))
    records = F.array_repeat(record, (F.col("c_custkey") % 3 + 1).cast("int"))
    responses = customer.select(F.to_json(records).alias("body"))
    return record_total(responses, "body", "nation int, persons int")


# --- loads --------------------------------------------------------------------------------


def _month_table(spark, sf_dir, times=1) -> FeedTable:
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="day")
    stage = scratch_path(spark, "stage")
    load_feed(spark, month_feed(spark, sf_dir), stage, loaded)
    for _ in range(times - 1):
        append_stage(spark, stage, loaded)
    return loaded


def _years_table(spark, sf_dir) -> FeedTable:
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="year")
    load_feed(spark, years_feed(spark, sf_dir), scratch_path(spark, "stage"), loaded)
    return loaded


def _queried_table(spark, feed, by) -> FeedTable:
    """The feed as a table to query, loaded without a stage."""
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by)
    create_if_absent(spark, loaded)
    append(spark, loaded, typed_rows(feed))
    return loaded


def load_by_day(spark, sf_dir):
    return _sums(spark.table(_month_table(spark, sf_dir).name), "date")


def load_by_year(spark, sf_dir):
    rows = spark.table(_years_table(spark, sf_dir).name)
    return _sums(rows, F.col("date_year").alias("year"))


def append_twice(spark, sf_dir):
    return _sums(spark.table(_month_table(spark, sf_dir, times=2).name), "date")


def _loaded_window(spark, pulled, window) -> tuple[FeedTable, LoadReport]:
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="day")
    return loaded, load_feed(spark, pulled, scratch_path(spark, "stage"), loaded, window)


def weekly_load(spark, sf_dir):
    """The weekly run of 2024-01-16: pull its default window, stage, load."""
    window = load_window(datetime.date(2024, 1, 16))
    loaded, _ = _loaded_window(spark, month_feed(spark, sf_dir, *window), window)
    return spark.table(loaded.name)


def weekly_load_counts(spark, sf_dir):
    """What became of every line when a month that lacks some dates is staged for a week."""
    window = load_window(datetime.date(2024, 1, 16))
    undated = F.when(F.col("hour") == "7", "n/a").otherwise(F.col("date"))
    pulled = month_feed(spark, sf_dir).withColumn("date", undated)
    _, report = _loaded_window(spark, pulled, window)
    row = (report.n_rows, report.n_without_date, report.n_outside_window, report.n_corrupt_lines)
    names = "n_rows bigint, n_without_date bigint, n_outside bigint, n_corrupt bigint"
    return spark.createDataFrame([row], names)


def open_load(spark, sf_dir):
    """A load from a day on, to the newest row."""
    window = load_window(datetime.date(2024, 1, 16), open_end=True)
    loaded, _ = _loaded_window(spark, month_feed(spark, sf_dir), window)
    return _sums(spark.table(loaded.name), "date")


def load_counts(spark, sf_dir):
    stage = scratch_path(spark, "stage")
    write_stage(years_feed_with_gaps(spark, sf_dir), stage)
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="year")
    report = append_stage(spark, stage, loaded)
    row = (report.n_rows, report.n_bad_values, report.n_corrupt_lines)
    return spark.createDataFrame([row], "n_rows bigint, n_bad_values bigint, n_corrupt bigint")


def load_rejects(spark, sf_dir):
    stage = scratch_path(spark, "stage")
    write_stage(years_feed_with_gaps(spark, sf_dir), stage)
    return stage_rejects(spark, stage)


def replace_window_day(spark, sf_dir):
    loaded = _month_table(spark, sf_dir)
    replace_window(spark, loaded, typed_rows(month_feed(spark, sf_dir)), *WEEK)
    replace_window(spark, loaded, typed_rows(month_feed(spark, sf_dir)), *MONTH)
    return spark.table(loaded.name)


def replace_window_year(spark, sf_dir):
    loaded = _queried_table(spark, years_feed(spark, sf_dir), "year")
    corrected = typed_rows(years_feed(spark, sf_dir)).withColumn(
        "vehicles_vtoll", F.col("vehicles_vtoll") + 1
    )
    start, stop = datetime.date(1997, 12, 20), datetime.date(1998, 2, 10)
    replace_window(spark, loaded, corrected, start, stop)
    return _sums(spark.table(loaded.name), "date")


def stage_fields(spark, sf_dir):
    """Fields of a stage that has drifted: one is new, one is a number, one is at times missing."""
    feed = years_feed(spark, sf_dir)
    plazas, hours = F.col("plaza_id").cast("int"), F.col("hour").cast("int")
    drifted = feed.select(
        "plaza_id",
        F.when(hours >= 6, F.col("date")).alias("date"),
        F.when(hours < 12, F.to_json(F.struct("hour"))).alias("note"),
        hours.alias("hour"),
        F.when(plazas > 25, F.struct("plaza_id", "direction")).alias("lane"),
        (plazas % 2 == 0).alias("direction"),
        "vehicles_e_zpass",
    )
    stage = scratch_path(spark, "stage")
    write_stage(drifted, stage)
    return stage_drift(spark, stage)


def backfill_ledger(spark, sf_dir):
    """A backfill year by year, twice: the second call finds all windows done."""
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="year")
    stage, ledger = scratch_path(spark, "stage"), scratch_path(spark, "ledger")
    for _ in range(2):
        backfill(
            spark, lambda a, b: years_feed(spark, sf_dir, a, b), stage, loaded, ledger, *ALL_YEARS
        )
    held = spark.table(loaded.name).groupBy("date").agg(F.count("*").alias("n"))
    noted = read_ledger(spark, ledger).select("start", "stop", "n_rows")
    inside = (F.col("date") >= F.col("start")) & (F.col("date") < F.col("stop"))
    # few windows and a sum per day
    return (
        noted.join(held, inside, "left")
        .groupBy("start", "stop", "n_rows")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_held"))
    )


def _corrections(spark, sf_dir):
    """Of a week's rows in direction I: a corrected one, an older one, and one of another plaza."""
    rows = typed_rows(month_feed(spark, sf_dir, *WEEK)).where("direction = 'I'")
    tolls = F.col("vehicles_vtoll")
    right = rows.withColumn("vehicles_vtoll", tolls + 1).withColumn("revision", F.lit(2))
    old = rows.withColumn("vehicles_vtoll", tolls + 100).withColumn("revision", F.lit(1))
    other = right.withColumn("plaza_id", F.concat(F.lit("9"), "plaza_id"))
    return right.unionByName(old).unionByName(other)


def upsert_window(spark, sf_dir):
    """Late corrections and new rows, put into a loaded table twice."""
    loaded = _month_table(spark, sf_dir)
    for _ in range(2):
        upsert(spark, loaded, _corrections(spark, sf_dir), newest="revision")
    return spark.table(loaded.name)


def kept_sums(spark, sf_dir):
    """Daily sums kept beside a table through an append and a replacement of some days."""
    loaded = _queried_table(spark, month_feed(spark, sf_dir), "day")
    sums = DailySums(f"{scratch_database(spark)}.traffic_daily", loaded)
    create_sums(spark, sums)
    append_summed(spark, sums, typed_rows(month_feed(spark, sf_dir, *WEEK)))
    days = datetime.date(2024, 1, 13), datetime.date(2024, 1, 18)
    corrected = typed_rows(month_feed(spark, sf_dir, *days)).where("direction = 'I'")
    corrected = corrected.withColumn("vehicles_vtoll", F.col("vehicles_vtoll") + 1)
    with summed_again(spark, sums, *days):
        replace_window(spark, loaded, corrected, *days)
    return spark.table(sums.name).drop("date_year")


def read_window_year(spark, sf_dir):
    loaded = _queried_table(spark, years_feed(spark, sf_dir), "year")
    return read_window(spark, loaded, datetime.date(1998, 12, 28), datetime.date(1999, 1, 4))


def incremental_stage(spark, sf_dir):
    feed = month_feed(spark, sf_dir)
    first = F.to_date("date") < F.lit(WEEK[1])
    stage, checkpoint = scratch_path(spark, "stage"), scratch_path(spark, "progress")
    loaded = FeedTable(f"{scratch_database(spark)}.traffic_hourly", by="day", batched=True)
    feed.where(first).write.mode("append").json(stage)
    load_new_files(spark, stage, loaded, checkpoint)
    feed.where(~first).write.mode("append").json(stage)
    load_new_files(spark, stage, loaded, checkpoint)
    load_new_files(spark, stage, loaded, checkpoint, most_partitions=1)
    return _sums(spark.table(loaded.name), "date")


# --- SQL and reports over a loaded table --------------------------------------------------


def sql_on_table(spark, sf_dir):
    return spark.sql(
        f"""
        SELECT CAST(hour AS int) AS hour, count(*) AS n_rows,
               sum(vehicles_e_zpass) AS e_zpass, sum(vehicles_vtoll) AS vtoll
        FROM {_queried_table(spark, month_feed(spark, sf_dir), "day").name}
        GROUP BY CAST(hour AS int)
        """
    )


def sql_plaza_day(spark, sf_dir):
    return spark.sql(
        f"""
        SELECT plaza_id, direction, date,
               sum(vehicles_e_zpass) AS e_zpass, sum(vehicles_vtoll) AS vtoll
        FROM {_queried_table(spark, years_feed(spark, sf_dir), "year").name}
        GROUP BY plaza_id, direction, date
        """
    )


def sql_pass_share(spark, sf_dir):
    return spark.sql(
        f"""
        SELECT plaza_id, date_year AS year,
               sum(vehicles_e_zpass) * 10000
                   DIV (sum(vehicles_e_zpass) + sum(vehicles_vtoll)) AS share_bp
        FROM {_queried_table(spark, years_feed(spark, sf_dir), "year").name}
        GROUP BY plaza_id, date_year
        """
    )


def missing_plaza_days(spark, sf_dir):
    return missing_days(typed_rows(years_feed(spark, sf_dir)), *ALL_YEARS, by=["plaza_id"])


def repeated_keys(spark, sf_dir):
    return duplicate_keys(typed_rows(years_feed(spark, sf_dir)))


QUERIES = {
    "paged_scan": paged_scan,
    "paged_scan_range": paged_scan_range,
    "paged_scan_filter": paged_scan_filter,
    "page_counts": page_row_counts,
    "limit_offset": limit_offset_top,
    "limit_offset_deep": limit_offset_deep,
    "json_stage_scan": json_stage_scan,
    "published_stage": published_stage,
    "json_decode": json_decode,
    "json_encode": json_encode,
    "parquet_roundtrip": parquet_roundtrip,
    "ctas_raw": ctas_raw,
    "storage_footprint": storage_footprint,
    "typed_rows": typed_feed,
    "date_range": date_range,
    "typed_date_range": typed_date_range,
    "date_range_open": date_range_open,
    "iso_literal": iso_literal,
    "day_parse": day_parse,
    "default_window": default_window,
    "drilldown_measure": drilldown_measure,
    "measure_stage": measure_stage,
    "record_total": response_totals,
    "load_by_day": load_by_day,
    "load_by_year": load_by_year,
    "append_twice": append_twice,
    "weekly_load": weekly_load,
    "weekly_load_counts": weekly_load_counts,
    "open_load": open_load,
    "load_counts": load_counts,
    "load_rejects": load_rejects,
    "replace_window": replace_window_day,
    "replace_window_year": replace_window_year,
    "upsert_window": upsert_window,
    "stage_drift": stage_fields,
    "backfill_ledger": backfill_ledger,
    "kept_sums": kept_sums,
    "read_window_year": read_window_year,
    "incremental_stage": incremental_stage,
    "sql_on_table": sql_on_table,
    "sql_plaza_day": sql_plaza_day,
    "sql_pass_share": sql_pass_share,
    "missing_days": missing_plaza_days,
    "duplicate_keys": repeated_keys,
}

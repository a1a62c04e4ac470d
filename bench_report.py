"""

Run by hand: BENCH_SF_DIR and BENCH_CPUS as for bench.py. Prints one line per measurement.
"""

from __future__ import annotations

import datetime
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedlake.plans import FeedTable, append_stage, read_window
from feedlake.sources import with_offsets, write_layout, write_stage
from feedlake.workspace import scratch_database, scratch_path
from registry.feeds import table, years_feed
from registry.queries import stored_bytes


def timed(label: str, action) -> None:
    began = time.perf_counter()
    action()
    print(f"{label}: {time.perf_counter() - began:.2f} s", flush=True)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_SCRATCH"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    for row in stored_bytes(spark, sf_dir).orderBy("format").collect():
        print(f"{row['format']}: {row.n_files} files, {row.n_bytes} bytes, {row.n_rows} rows")

    stage = scratch_path(spark, "stage")
    timed("stage as JSON", lambda: write_stage(years_feed(spark, sf_dir), stage))
    tables = {by: FeedTable(f"{scratch_database(spark)}.t", by) for by in ("day", "year")}
    for by, loaded in tables.items():
        timed(f"load the stage by {by}", lambda loaded=loaded: append_stage(spark, stage, loaded))

    week = datetime.date(1998, 3, 2), datetime.date(1998, 3, 9)
    unbounded = spark.table(tables["year"].name).where(
        F.col("date").between(week[0], week[1] - datetime.timedelta(days=1))
    )
    for _ in range(2):
        bounded = read_window(spark, tables["year"], *week)
        timed("one week by year, with bound", lambda bounded=bounded: run(bounded))
        timed("one week by year, without bound", lambda: run(unbounded))
        timed("one week by day", lambda: run(read_window(spark, tables["day"], *week)))

    lineitem = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    path = scratch_path(spark, "layout")
    keys = ["day", "l_orderkey", "l_linenumber"]
    layout = []
    timed("layout", lambda: layout.append(write_layout(lineitem, keys, path, settled=True)))
    for size in (100_000, 100_000, 10_000, 1_000):
        page = F.expr(f"row_offset div {size}").alias("page")
        pages = with_offsets(spark, layout[0]).groupBy(page).agg(F.sum("l_quantity"))
        timed(f"paged scan, pages of {size}", lambda pages=pages: run(pages))
    spark.stop()


if __name__ == "__main__":
    main()

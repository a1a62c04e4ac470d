"""Tasks that fail and run again must not lose, repeat or recount rows."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Its own session, as a local master retries tasks only when told so at the start.
SCRIPT = """
import json, os, sys
root, work = sys.argv[1:]
sys.path.insert(0, root)
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from feedlake.operators import typed_rows
from feedlake.plans import FeedTable, append, append_stage, create_if_absent
from feedlake.schema import WIRE_SCHEMA
from feedlake.sources import RequestFeed, read_feed, read_stage, register_feed, write_stage

spark = (
    SparkSession.builder.master("local[2,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", work + "/shared")
    .config("spark.sql.warehouse.dir", work + "/warehouse")
    .getOrCreate()
)

def once(name):
    marker = work + "/" + name
    if os.path.exists(marker):
        return False
    open(marker, "w").close()
    return True

def fetch(start, stop, limit, offset):
    if offset in (200, 600) and once(f"page-{offset}"):
        raise OSError("503")
    return [
        {"plaza_id": str(i), "date": f"2024-01-{1 + i % 28:02d}T00:00:00.000", "hour": "0",
         "direction": "I", "vehicles_e_zpass": "1", "vehicles_vtoll": "1"}
        for i in range(offset, offset + limit)
    ]

register_feed(spark, "flaky", RequestFeed(WIRE_SCHEMA, lambda a, b: 1000, fetch))
write_stage(read_feed(spark, "flaky", page_size=100), work + "/stage")
report = append_stage(spark, work + "/stage", FeedTable("staged"))

@F.udf("string")
def stumbling(text):
    if text == "500" and once("row-500"):
        raise OSError("lost")
    return text

direct = FeedTable("direct")
create_if_absent(spark, direct)
rows = typed_rows(read_stage(spark, work + "/stage")).withColumn("plaza_id", stumbling("plaza_id"))
appended = append(spark, direct, rows)
print(json.dumps({
    "report": report.n_rows, "appended": appended,
    "staged": spark.table("staged").select("plaza_id").distinct().count(),
    "staged_rows": spark.table("staged").count(),
    "direct_rows": spark.table("direct").count(),
    "failed": sorted(n for n in os.listdir(work) if n.startswith(("page", "row"))),
}))
"""


def test_retried_tasks_count_once(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, ROOT, str(tmp_path)],
        capture_output=True, text=True, timeout=300, cwd=tmp_path,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert json.loads(done.stdout.splitlines()[-1]) == {
        "report": 1000, "appended": 1000, "staged": 1000, "staged_rows": 1000,
        "direct_rows": 1000, "failed": ["page-200", "page-600", "row-500"],
    }

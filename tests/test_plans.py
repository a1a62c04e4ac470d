"""What reaches the scans, and what the library must not do."""

import glob
import io
import os
from contextlib import redirect_stdout

import pytest

from feedlake.workspace import shared_folder
from registry import feeds, queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"


def explained(frame):
    with redirect_stdout(io.StringIO()) as text:
        frame.explain("formatted")
    return text.getvalue()


def lines_with(text, label):
    return [line for line in text.splitlines() if label in line]


def test_a_window_of_a_year_table_prunes_years_and_row_groups(spark):
    text = explained(queries.read_window_year(spark, SF_DIR))
    assert any("date_year" in line for line in lines_with(text, "PartitionFilters"))
    assert any("GreaterThanOrEqual(date" in line for line in lines_with(text, "PushedFilters"))


def test_a_range_reaches_the_parquet_scan(spark):
    text = explained(queries.date_range(spark, SF_DIR))
    assert any("LessThan(l_shipdate" in line for line in lines_with(text, "PushedFilters"))
    assert all("l_tax" not in line for line in lines_with(text, "ReadSchema"))


@pytest.mark.parametrize("name", ["duplicate_keys", "load_by_year", "drilldown_measure"])
def test_aggregates_are_partial_before_they_shuffle(spark, name):
    assert "partial_count" in explained(queries.QUERIES[name](spark, SF_DIR)) or (
        "partial_sum" in explained(queries.QUERIES[name](spark, SF_DIR))
    )


@pytest.mark.parametrize("name", ["missing_days", "default_window", "drilldown_measure"])
def test_no_query_compares_all_pairs(spark, name):
    text = explained(queries.QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_the_deep_form_of_a_limit_is_no_sorted_limit(spark):
    assert "TakeOrderedAndProject" in explained(queries.limit_offset_top(spark, SF_DIR))
    assert "TakeOrderedAndProject" not in explained(queries.limit_offset_deep(spark, SF_DIR))


def test_the_week_reaches_the_scan_of_the_given_table(spark):
    week = explained(queries.paged_scan_filter(spark, SF_DIR))
    pulled = explained(feeds.month_feed(spark, SF_DIR, *queries.WEEK))
    for text in (week, pulled):
        assert any("GreaterThanOrEqual(ts" in x for x in lines_with(text, "PushedFilters"))
        assert any("LessThan(ts" in x for x in lines_with(text, "PushedFilters"))


def test_the_gap_report_scans_once_and_joins_nothing(spark):
    text = explained(queries.missing_plaza_days(spark, SF_DIR))
    assert "Join" not in text
    assert len(lines_with(text, "Location:")) == 1


def test_limits_cap_no_tasks(spark):
    assert "Coalesce" not in explained(queries.limit_offset_top(spark, SF_DIR))


# calls that move rows, and where a bounded number of them may
BOUNDED = {
    # one name per partition, per file that a replacement writes again, per window that is done
    ".collect(": [f"feedlake/plans/{n}.py" for n in ("tables", "swaps", "upserts", "backfills")],
    "to_pylist": [],
    "mkdtemp": [],
    "tempfile": [],
    "coalesce(": [],
}


def test_rows_reach_the_driver_only_where_they_are_few():
    paths = glob.glob(f"{ROOT}/feedlake/**/*.py", recursive=True)
    for path in (p for p in paths if "/llm/" not in p):
        name = os.path.relpath(path, ROOT)
        with open(path) as source:
            text = source.read().replace("F.coalesce(", "")
        for word, allowed in BOUNDED.items():
            assert word not in text or name in (allowed or []), (name, word)


def test_the_library_keeps_rows_off_the_driver():
    banned = ["toPandas", ".rdd", "localCheckpoint", "crossJoin", "toLocalIterator"]
    for path in glob.glob(f"{ROOT}/feedlake/**/*.py", recursive=True):
        with open(path) as source:
            text = source.read()
        assert not [word for word in banned if word in text], path


def test_scratch_goes_to_the_folder_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class UnsetSession:
    """A session that names no checkpoint folder, as far as `shared_folder` looks at it."""

    def __init__(self):
        self.conf = {"spark.sql.warehouse.dir": "s3://bucket/warehouse/"}
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_without_a_checkpoint_folder_the_warehouse_holds_scratch():
    assert shared_folder(UnsetSession()) == "s3://bucket/warehouse"

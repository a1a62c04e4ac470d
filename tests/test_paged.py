import datetime
import subprocess
import sys
import uuid

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.operators import in_window
from feedlake.sources import RequestFeed, read_feed, register_feed
from feedlake.sources.paged import page_runs

D = datetime.date
SCHEMA = StructType().add("id", "long").add("day", "date").add("label", "string")


def service(total, per_day=10):
    """Functions that answer like a web service with `total` rows, `per_day` of them a day."""

    def records(start, stop):
        everything = (
            {"id": i, "day": D(2024, 1, 1) + datetime.timedelta(days=i // per_day), "label": i}
            for i in range(total)
        )
        return [
            r for r in everything
            if (start is None or r["day"] >= start) and (stop is None or r["day"] < stop)
        ]

    def count_rows(start, stop):
        return len(records(start, stop))

    def fetch(start, stop, limit, offset):
        return records(start, stop)[offset : offset + limit]

    return count_rows, fetch


def registered(spark, count_rows, fetch, day_column="day"):
    name = f"feed_{uuid.uuid4().hex}"
    register_feed(spark, name, RequestFeed(SCHEMA, count_rows, fetch, day_column))
    return name


@given(st.integers(0, 10_000), st.integers(1, 700), st.integers(1, 50))
def test_runs_cover_every_row_once_and_start_at_pages(total, page_size, min_runs):
    runs = page_runs(total, page_size, min_runs)
    at = 0
    for offset, rows in runs:
        assert offset == at and rows > 0 and offset % page_size == 0
        at += rows
    assert at == total


def test_tasks_grow_with_the_feed_unless_the_caller_bounds_them():
    assert len(page_runs(10**11, 100_000, 8)) == 10**5
    assert len(page_runs(10**11, 100_000, 8, 300)) <= 300
    assert len(page_runs(10**6, 1_000, 64, 3)) == 3


def test_registering_a_feed_leaves_the_session_as_it_is(spark):
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    registered(spark, *service(1))
    assert spark.conf.get("spark.sql.python.filterPushdown.enabled") == before


@pytest.mark.parametrize("total", [0, 1, 9, 10, 11, 20, 35])
@pytest.mark.parametrize("page_size", [1, 10, 1000])
def test_every_page_is_read(spark, total, page_size):
    name = registered(spark, *service(total))
    rows = read_feed(spark, name, page_size=page_size, page_column="page").collect()
    assert sorted((r.id, r.page) for r in rows) == [(i, i // page_size) for i in range(total)]


def test_pages_are_numbered_within_the_window(spark):
    name = registered(spark, *service(100))
    window = D(2024, 1, 3), D(2024, 1, 6)
    rows = read_feed(spark, name, *window, page_size=7, page_column="page").collect()
    assert sorted((r.id, r.page) for r in rows) == [(20 + i, i // 7) for i in range(30)]


def test_pages_become_tasks(spark):
    name = registered(spark, *service(40))
    frame = read_feed(spark, name, page_size=10)
    assert frame.select(F.spark_partition_id()).distinct().count() == 4


def test_tasks_can_be_held_to_what_a_service_bears(spark):
    name = registered(spark, *service(40))
    frame = read_feed(spark, name, page_size=10, max_tasks=2)
    assert frame.select(F.spark_partition_id()).distinct().count() == 2


def test_executors_need_no_copy_of_this_package(spark, tmp_path):
    name = registered(spark, *service(3))
    assert read_feed(spark, name).count() == 3
    feed = RequestFeed(SCHEMA, lambda a, b: 3, lambda a, b, n, o: [{"id": 1}] * n)
    (tmp_path / "feed.pickle").write_bytes(cloudpickle.dumps(feed))
    script = (
        "import pickle; feed = pickle.load(open('feed.pickle', 'rb'));"
        "print(sum(b.num_rows for b in feed.rows(None, None, 0, 3, 2, ['id'])))"
    )
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert done.stdout.strip() == "3"


def test_values_that_are_not_text_become_text(spark):
    name = registered(
        spark, lambda a, b: 3, lambda a, b, n, o: [{"label": 5}, {"label": {"x": 1}}, {"id": 1}]
    )
    assert {r.label for r in read_feed(spark, name).collect()} == {"5", '{"x": 1}', None}


@pytest.mark.parametrize(
    "answer", [[], [{"id": 1}], [{"id": 1}] * 3, {"error": True}, "no", [1, 2]]
)
def test_a_page_that_is_not_what_was_asked_for_fails_the_read(spark, answer):
    name = registered(spark, lambda a, b: 2, lambda a, b, n, o: answer)
    with pytest.raises(PySparkException):
        read_feed(spark, name).collect()


def test_a_request_that_fails_fails_the_read(spark):
    def fetch(start, stop, limit, offset):
        raise OSError("503")

    with pytest.raises(PySparkException):
        read_feed(spark, registered(spark, lambda a, b: 2, fetch)).collect()


@pytest.mark.parametrize(
    "condition, window",
    [
        ("day >= DATE'2024-01-02' AND day < DATE'2024-01-05'", "2024-01-02 2024-01-05"),
        ("day > DATE'2024-01-02' AND day <= DATE'2024-01-05'", "2024-01-03 2024-01-06"),
        ("day = DATE'2024-01-02'", "2024-01-02 2024-01-03"),
        ("day >= DATE'2024-01-02'", "2024-01-02 None"),
        ("day >= DATE'2024-01-02' AND day >= DATE'2024-01-04'", "2024-01-04 None"),
    ],
)
def test_ranges_reach_the_feed(spark, conf, condition, window):
    conf("spark.sql.python.filterPushdown.enabled", "true")

    def fetch(start, stop, limit, offset):
        return [{"day": D(2024, 1, 1), "label": f"{start} {stop}"}]

    frame = read_feed(spark, registered(spark, lambda a, b: 1, fetch)).where(condition)
    assert [r.label for r in frame.collect()] == [window]


def test_options_and_filters_narrow_together(spark):
    name = registered(spark, *service(100))
    frame = read_feed(spark, name, D(2024, 1, 2), D(2024, 1, 8))
    frame = in_window(frame, D(2024, 1, 5), D(2024, 1, 20), "day")
    assert sorted(r.id for r in frame.collect()) == list(range(40, 70))
    nothing = frame.where("day < DATE'2024-01-05'")
    assert nothing.count() == 0


@pytest.mark.parametrize("pushdown", ["true", "false"])
@pytest.mark.parametrize(
    "condition",
    [
        "id = 7",
        "day IN (DATE'2024-01-02', DATE'2024-01-04')",
        "day <> DATE'2024-01-02'",
        "day >= DATE'2024-01-02' OR id < 3",
        "day <= DATE'9999-12-31' AND id > 3",
        "day IS NULL",
        "label LIKE '1%'",
    ],
)
def test_filters_the_feed_cannot_apply_stay_with_spark(spark, conf, pushdown, condition):
    name = registered(spark, *service(60))
    conf("spark.sql.python.filterPushdown.enabled", pushdown)
    everything = read_feed(spark, name).collect()
    plain = spark.createDataFrame(everything, SCHEMA)
    expected = sorted(r.id for r in plain.where(condition).collect())
    assert sorted(r.id for r in read_feed(spark, name).where(condition).collect()) == expected


@pytest.mark.parametrize("pushdown", ["true", "false"])
def test_page_numbers_do_not_depend_on_pushdown(spark, conf, pushdown):
    name = registered(spark, *service(60))
    conf("spark.sql.python.filterPushdown.enabled", pushdown)
    frame = read_feed(spark, name, page_size=7, page_column="page")
    found = in_window(frame, D(2024, 1, 3), D(2024, 1, 4), "day").collect()
    assert sorted((r.id, r.page) for r in found) == [(i, i // 7) for i in range(20, 30)]


def test_columns_are_left_out_on_request(spark):
    name = registered(spark, *service(5))
    frame = read_feed(spark, name, columns=["label", "id"])
    assert frame.columns == ["label", "id"]
    assert sorted(r.id for r in frame.collect()) == [0, 1, 2, 3, 4]


def test_page_size_must_be_positive(spark):
    with pytest.raises(PySparkException):
        read_feed(spark, registered(spark, *service(5)), page_size=0).collect()

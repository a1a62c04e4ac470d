import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions import (
    default_bounds,
    load_window,
    midnight_literal,
    midnight_text,
    parse_day,
)

D = datetime.date


def test_default_window_is_seven_days_up_to_two_days_before_the_run():
    assert load_window(D(2024, 1, 16)) == (D(2024, 1, 8), D(2024, 1, 15))


def test_given_bounds_are_kept():
    run = D(2024, 1, 16)
    assert load_window(run, D(2019, 1, 1), D(2023, 1, 1)) == (D(2019, 1, 1), D(2023, 1, 1))
    assert load_window(run, start=D(2024, 1, 1)) == (D(2024, 1, 1), D(2024, 1, 15))
    assert load_window(run, stop=D(2024, 1, 10)) == (D(2024, 1, 8), D(2024, 1, 10))
    assert load_window(run, start=D(2024, 1, 1), open_end=True) == (D(2024, 1, 1), None)


def test_a_window_that_ends_before_it_starts_is_refused():
    with pytest.raises(ValueError):
        load_window(D(2024, 1, 16), start=D(2024, 2, 1))


@given(st.dates(D(1990, 1, 1), D(2050, 1, 1)))
def test_weekly_windows_tile(run):
    following = run + datetime.timedelta(days=7)
    assert load_window(run)[1] == load_window(following)[0]


def test_column_and_python_windows_agree(spark):
    runs = [D(2024, 1, 15), D(2024, 3, 4), D(2023, 1, 2)]
    frame = spark.createDataFrame([(r,) for r in runs], "run date")
    start, stop = default_bounds("run")
    rows = frame.select("run", start.alias("a"), stop.alias("b")).collect()
    assert {r.run: (r.a, r.b) for r in rows} == {r: load_window(r) for r in runs}


def test_parse_day(spark):
    texts = ["2024-02-29", "2023-4-1", "2023-02-29", "2023-13-01", "20230401", "abc", "", None,
             "2023-04-01T00:00:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in frame.select("t", parse_day("t").alias("d")).collect()}
    expected = dict.fromkeys(texts)
    expected["2024-02-29"], expected["2023-4-1"] = D(2024, 2, 29), D(2023, 4, 1)
    assert got == expected


def test_midnight_drops_the_time_of_day(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2023-12-31 23:59:59' AS t, DATE'2023-12-31' AS d")
    row = frame.select(midnight_literal("t").alias("t"), midnight_literal(F.col("d")).alias("d"))
    assert set(row.first()) == {"2023-12-31T00:00:00.00"} == {midnight_text(D(2023, 12, 31))}

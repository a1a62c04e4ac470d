import datetime

from pyspark.sql import functions as F

from feedlake.operators import bad_value_count, duplicate_keys, missing_days, rejects, typed_rows
from feedlake.schema import CORRUPT_COLUMN, TYPED_SCHEMA, WIRE_SCHEMA
from feedlake.sources.staged import staged_schema

D = datetime.date
GOOD = ("21", "2023-04-10T00:00:00.000", "0", "I", "12", "3")


def wire(spark, **changes):
    row = dict(zip(WIRE_SCHEMA.names, GOOD)) | changes
    return spark.createDataFrame([tuple(row[n] for n in WIRE_SCHEMA.names)], WIRE_SCHEMA)


def test_types(spark):
    typed = typed_rows(wire(spark))
    assert typed.schema == TYPED_SCHEMA
    assert tuple(typed.first()) == ("21", D(2023, 4, 10), "0", "I", 12, 3)


def test_counts(spark):
    expected = {"12": 12, " 12 ": 12, "12.7": None, "abc": None, "": None, "9999999999": None,
                "1e2": None, "-3": -3, None: None}
    for text, value in expected.items():
        assert typed_rows(wire(spark, vehicles_vtoll=text)).first().vehicles_vtoll == value, text


def test_dates(spark):
    day = D(2023, 4, 10)
    expected = {
        "2023-04-10T00:00:00.000": day, "2023-4-10": day, "2023-04-10 23:59:59": day,
        "2024-02-29": D(2024, 2, 29), "2023-02-29": None, "2023-12-31": D(2023, 12, 31),
        "2023-13-01": None, "abc": None, "": None, None: None,
    }
    for text, value in expected.items():
        assert typed_rows(wire(spark, date=text)).first().date == value, text


def test_rejects_name_the_value(spark):
    both = wire(spark, date="2023-13-01", vehicles_vtoll="12.7")
    found = rejects(both.unionAll(wire(spark)).unionAll(wire(spark, vehicles_vtoll=None)))
    assert {(r.field, r.raw_value) for r in found.collect()} == {
        ("date", "2023-13-01"), ("vehicles_vtoll", "12.7")
    }
    assert both.select(bad_value_count()).first()[0] == 2


def test_corrupt_lines_are_rejected_not_loaded(spark):
    lines = [(*GOOD, None), (None,) * 6 + ("{broken",)]
    frame = spark.createDataFrame(lines, staged_schema())
    assert typed_rows(frame).count() == 1
    assert [(r.field, r.raw_value) for r in rejects(frame).collect()] == [
        (CORRUPT_COLUMN, "{broken")
    ]


def test_duplicate_keys(spark):
    rows = typed_rows(wire(spark).unionAll(wire(spark, vehicles_vtoll="9")))
    rows = rows.unionAll(typed_rows(wire(spark, hour="1")))
    assert [tuple(r) for r in duplicate_keys(rows).collect()] == [
        ("21", D(2023, 4, 10), "0", "I", 2)
    ]


def test_missing_days(spark):
    rows = spark.createDataFrame(
        [("a", D(2024, 2, 28)), ("a", D(2024, 3, 1)), ("b", D(2024, 2, 29)), ("b", None)],
        "plaza_id string, date date",
    )
    window = D(2024, 2, 28), D(2024, 3, 2)
    assert missing_days(rows, *window).count() == 0
    found = missing_days(rows, *window, by=["plaza_id"]).collect()
    assert {tuple(r) for r in found} == {
        ("a", D(2024, 2, 29)), ("b", D(2024, 2, 28)), ("b", D(2024, 3, 1))
    }
    alone = missing_days(rows.where(F.col("plaza_id") == "a"), *window)
    assert [r.date for r in alone.collect()] == [D(2024, 2, 29)]
    assert missing_days(rows, window[1], window[0]).count() == 0

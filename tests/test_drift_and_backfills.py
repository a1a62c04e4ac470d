import datetime
import json

import pytest

from feedlake.operators import stage_drift
from feedlake.plans import FeedTable, backfill, read_ledger, windows
from feedlake.schema import WIRE_SCHEMA

D = datetime.date


def drift(spark, tmp_path, *lines):
    (tmp_path / "stage").mkdir()
    (tmp_path / "stage" / "a.json").write_text("\n".join(lines))
    rows = stage_drift(spark, str(tmp_path / "stage")).collect()
    return {(r.field, r.kind): (r.n_values, r.declared, r.conflict) for r in rows}


def test_undeclared_fields_and_kinds_are_reported(spark, tmp_path):
    declared = {(f.name, "absent"): (0, True, False) for f in WIRE_SCHEMA}
    found = drift(
        spark, tmp_path,
        json.dumps({"plaza_id": "21", "date": 5, "hour": None, "Hour": "x", "a.b": [1], "": True}),
        json.dumps({"plaza_id": "é", "date": 5.5, "hour": "1", "lane": {"x": 1}}),
        json.dumps({"plaza_id": {"a": 1}, "date": 10**30, "direction": False}),
        "{}", "", "  ", "[1, 2]", "7", '{"plaza_id": "2', "null",
    )
    for name in ("plaza_id", "date", "hour", "direction"):
        del declared[name, "absent"]
    assert found == {
        **declared,
        ("plaza_id", "string"): (2, True, False), ("plaza_id", "object"): (1, True, True),
        ("date", "number"): (3, True, True), ("hour", "null"): (1, True, False),
        ("hour", "string"): (1, True, False), ("direction", "boolean"): (1, True, True),
        ("Hour", "string"): (1, False, False), ("a.b", "array"): (1, False, False),
        ("", "boolean"): (1, False, False), ("lane", "object"): (1, False, False),
        (None, "corrupt"): (4, False, False),
    }


def test_an_empty_stage_has_no_field(spark, tmp_path):
    assert drift(spark, tmp_path) == {(f.name, "absent"): (0, True, False) for f in WIRE_SCHEMA}


def test_windows_tile_the_range():
    assert windows(D(2024, 1, 1), D(2024, 1, 8), 3) == [
        (D(2024, 1, 1), D(2024, 1, 4)), (D(2024, 1, 4), D(2024, 1, 7)), (D(2024, 1, 7), D(2024, 1, 8))
    ]
    assert windows(D(2024, 1, 1), D(2024, 1, 3), 99) == [(D(2024, 1, 1), D(2024, 1, 3))]
    for bad in ((D(2024, 1, 2), D(2024, 1, 2), 1), (D(2024, 1, 1), D(2024, 1, 2), 0)):
        with pytest.raises(ValueError):
            windows(*bad)


@pytest.mark.parametrize("by", ["day", "year"])
def test_a_broken_backfill_goes_on_where_it_stopped(spark, tmp_path, database, by):
    table, pulled = FeedTable(f"{database}.t", by), []

    def pull(start, stop):
        pulled.append(start)
        if start == broken:
            raise OSError("503")
        days = [start + datetime.timedelta(days=k) for k in range((stop - start).days)]
        rows = [("21", f"{d}T00:00:00.000", "0", "I", "1", "bad" if d.day == 1 else "2") for d in days]
        return spark.createDataFrame(rows, WIRE_SCHEMA)

    def run(stop=D(2024, 1, 10)):
        where = str(tmp_path / "stage"), table, str(tmp_path / "ledger")
        return backfill(spark, pull, *where, D(2023, 12, 29), stop, days=4)

    broken = D(2024, 1, 2)
    with pytest.raises(OSError):
        run()
    assert spark.table(table.name).count() == 4
    broken = None
    assert [r.n_rows for r in run()] == [4, 4]
    assert pulled == [D(2023, 12, 29), D(2024, 1, 2), D(2024, 1, 2), D(2024, 1, 6)]
    assert run() == [] and len(pulled) == 4
    assert [r.n_rows for r in run(D(2024, 1, 12))] == [2]
    days = [r.date for r in spark.table(table.name).orderBy("date").collect()]
    assert days == [D(2023, 12, 29) + datetime.timedelta(days=k) for k in range(14)]
    noted = read_ledger(spark, str(tmp_path / "ledger")).collect()
    assert sorted((r.start, r.n_rows, r.n_bad_values) for r in noted) == [
        (D(2023, 12, 29), 4, 1), (D(2024, 1, 2), 4, 0), (D(2024, 1, 6), 4, 0), (D(2024, 1, 10), 2, 0)
    ]


def test_a_ledger_serves_several_tables(spark, tmp_path, database):
    def pull(start, stop):
        return spark.createDataFrame([("21", str(start), "0", "I", "1", "2")], WIRE_SCHEMA)

    for name in ("a", "b"):
        table = FeedTable(f"{database}.{name}")
        where = str(tmp_path / name), table, str(tmp_path / "ledger")
        assert len(backfill(spark, pull, *where, D(2024, 1, 1), D(2024, 1, 3), days=1)) == 2
    assert read_ledger(spark, str(tmp_path / "ledger")).count() == 4

import pytest
from test_tables import D, files_of, rows_on

from feedlake.plans import (
    DailySums,
    FeedTable,
    append,
    append_summed,
    create_if_absent,
    create_sums,
    daily,
    daily_sums,
    finish_sums,
    refresh_sums,
    replace_window,
    summed_again,
)
from feedlake.schema import TYPED_SCHEMA

A, B, C = D(2023, 12, 31), D(2024, 1, 1), D(2024, 6, 1)


def made(spark, database, by, *days):
    table = FeedTable(f"{database}.t", by)
    create_if_absent(spark, table)
    append(spark, table, rows_on(spark, *days))
    sums = DailySums(f"{database}.sums", table)
    create_sums(spark, sums)
    return sums


def content(rows):
    names = ["date", "plaza_id", "direction", "n_rows", "vehicles_e_zpass", "vehicles_vtoll"]
    return sorted(map(tuple, rows.select(*names).collect()))


def held(spark, sums):
    return content(spark.table(sums.name))


def summed(spark, sums):
    return content(daily_sums(spark.table(sums.of.name), sums.by))


@pytest.mark.parametrize("by", ["day", "year"])
def test_sums_follow_appends_and_replacements(spark, database, by):
    sums = made(spark, database, by, A, B, B)
    assert held(spark, sums) == summed(spark, sums) != []
    assert append_summed(spark, sums, rows_on(spark, B, C, None)) == 3
    assert held(spark, sums) == summed(spark, sums) and len(held(spark, sums)) == 3
    with summed_again(spark, sums, A, C):
        replace_window(spark, sums.of, rows_on(spark, A, vtoll=7), A, C)
    assert held(spark, sums) == summed(spark, sums) and len(held(spark, sums)) == 2
    with summed_again(spark, sums, A):
        replace_window(spark, sums.of, rows_on(spark), A)
    assert held(spark, sums) == []


def test_only_the_days_of_the_change_are_summed(spark, database):
    sums = made(spark, database, "day", A, B, C)
    append(spark, sums.of, rows_on(spark, A, B, C))  # unnoticed
    assert append_summed(spark, sums, rows_on(spark, B)) == 1
    assert [(r[0], r[3]) for r in held(spark, sums)] == [(A, 1), (B, 3), (C, 1)]
    assert refresh_sums(spark, sums, C) == 1
    assert [(r[0], r[3]) for r in held(spark, sums)] == [(A, 1), (B, 3), (C, 2)]


def test_files_of_other_years_stay(spark, database):
    sums = made(spark, database, "year", A, B)
    before = files_of(spark, sums)
    append_summed(spark, sums, rows_on(spark, C))
    after = files_of(spark, sums)
    kept = [file for file in before if "date_year=2023" in file[0]]
    assert len(kept) == 1 and kept[0] in after and len(after.keys() - before.keys()) == 1


def test_creating_again_reads_nothing(spark, database, monkeypatch):
    sums = made(spark, database, "day", A)
    monkeypatch.setattr(daily, "refresh_sums", None)
    create_sums(spark, sums)
    assert len(held(spark, sums)) == 1


def test_a_creation_that_broke_off_is_gone_on_with(spark, database, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(daily, "swap_files", None)
        with pytest.raises(TypeError):
            made(spark, database, "day", A, B)
    sums = DailySums(f"{database}.sums", FeedTable(f"{database}.t"))
    assert held(spark, sums) == []
    create_sums(spark, sums)
    assert held(spark, sums) == summed(spark, sums) != []


def test_sums_that_broke_off_are_made_by_the_next_call(spark, database, monkeypatch):
    sums = made(spark, database, "day", A, B)
    with monkeypatch.context() as patch:
        patch.setattr(daily, "swap_files", None)
        with pytest.raises(TypeError):
            append_summed(spark, sums, rows_on(spark, A))
        with pytest.raises(TypeError):  # the first is tried again
            append_summed(spark, sums, rows_on(spark, B))
    assert held(spark, sums) != summed(spark, sums)
    with pytest.raises(RuntimeError), summed_again(spark, sums, C, D(2024, 6, 2)):
        append(spark, sums.of, rows_on(spark, C))
        raise RuntimeError
    assert finish_sums(spark, sums) == 1 and finish_sums(spark, sums) == 0
    assert held(spark, sums) == summed(spark, sums) and len(held(spark, sums)) == 3


def test_an_empty_table_and_an_empty_append(spark, database):
    sums = made(spark, database, "year")
    assert held(spark, sums) == []
    assert append_summed(spark, sums, rows_on(spark)) == 0
    assert append_summed(spark, sums, rows_on(spark, None)) == 1
    assert held(spark, sums) == []


def test_null_keys_and_counts(spark, database):
    sums = made(spark, database, "day", A)
    rows = [(None, A, "0", None, None, 2), (None, A, "1", None, None, 3)]
    append_summed(spark, sums, spark.createDataFrame(rows, TYPED_SCHEMA))
    found = spark.table(sums.name).where("plaza_id is null").collect()
    assert [(r.n_rows, r.vehicles_e_zpass, r.vehicles_vtoll) for r in found] == [(2, None, 5)]


def test_sums_by_other_columns_are_refused():
    for by in (("date",), ("nothing",), ("vehicles_vtoll",)):
        with pytest.raises(ValueError):
            DailySums("s", FeedTable("t"), by)
    assert DailySums("s", FeedTable("t"), ()).partition_columns == ["date_year"]

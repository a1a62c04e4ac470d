import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedlake.plans import (
    FeedTable,
    append,
    create_if_absent,
    create_raw,
    create_statement,
    read_window,
    replace_window,
)
from feedlake.plans import swaps
from feedlake.plans.tables import finish_replacements
from feedlake.schema import TYPED_SCHEMA, WIRE_SCHEMA

D = datetime.date


def rows_on(spark, *days, vtoll=1):
    return spark.createDataFrame([("21", d, "0", "I", 1, vtoll) for d in days], TYPED_SCHEMA)


def made(spark, database, by, *days, name="t"):
    table = FeedTable(f"{database}.{name}", by)
    create_if_absent(spark, table)
    append(spark, table, rows_on(spark, *days))
    return table


def content(spark, table):
    found = spark.table(table.name).select("date", "vehicles_vtoll").collect()
    return sorted(map(tuple, found), key=str)


def test_creating_twice_keeps_the_rows(spark, database):
    table = made(spark, database, "day", D(2024, 1, 1))
    create_if_absent(spark, table)
    assert spark.table(table.name).count() == 1


def test_another_partitioning_is_refused(spark, database):
    made(spark, database, "day", D(2024, 1, 1))
    with pytest.raises(ValueError):
        create_if_absent(spark, FeedTable(f"{database}.t", "year"))
    with pytest.raises(ValueError):
        FeedTable("t", "month")


def test_raw_table_keeps_text_and_is_created_once(spark, database):
    raw = spark.createDataFrame([("21", "2024-01-01", "0", "I", "1", "2")], WIRE_SCHEMA)
    create_raw(raw, f"{database}.raw")
    assert {t for _, t in spark.table(f"{database}.raw").dtypes} == {"string"}
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        create_raw(raw, f"{database}.raw")


@pytest.mark.parametrize("by", ["day", "year"])
def test_appends_add_up_and_go_by_name(spark, database, by):
    table = made(spark, database, by, D(2024, 1, 1))
    shuffled = rows_on(spark, D(2024, 1, 1), vtoll=5).select(*reversed(TYPED_SCHEMA.names))
    assert append(spark, table, shuffled) == 1
    assert content(spark, table) == [(D(2024, 1, 1), 1), (D(2024, 1, 1), 5)]


@pytest.mark.parametrize("by", ["day", "year"])
def test_missing_and_extra_columns(spark, database, by):
    table = made(spark, database, by)
    append(spark, table, rows_on(spark, D(2024, 1, 1)).drop("hour"))
    assert spark.table(table.name).first().hour is None
    with pytest.raises(AnalysisException):
        append(spark, table, rows_on(spark, D(2024, 1, 1)).withColumn("extra", F.lit(1)))
    assert spark.table(table.name).count() == 1


@pytest.mark.parametrize("by", ["day", "year"])
def test_rows_without_a_date_are_loaded(spark, database, by):
    table = made(spark, database, by, None, D(2024, 1, 1))
    assert spark.table(table.name).where("date IS NULL").count() == 1


@pytest.mark.parametrize("by", ["day", "year"])
@pytest.mark.parametrize(
    "start, stop, inside",
    [
        (D(2023, 12, 31), D(2024, 1, 2), [D(2023, 12, 31), D(2024, 1, 1)]),
        (D(2024, 1, 1), D(2024, 1, 2), [D(2024, 1, 1)]),
        (D(2023, 1, 1), D(2024, 1, 1), [D(2023, 12, 31)]),
        (D(2024, 2, 29), None, [D(2024, 2, 29), D(2025, 1, 1)]),
        (None, D(2023, 12, 31), []),
        (D(2024, 1, 2), D(2024, 1, 2), []),
    ],
)
def test_read_window(spark, database, by, start, stop, inside):
    days = [D(2023, 12, 31), D(2024, 1, 1), D(2024, 2, 29), D(2025, 1, 1)]
    table = made(spark, database, by, *days)
    found = read_window(spark, table, start, stop)
    assert found.columns == spark.table(table.name).drop("date_year").columns
    assert sorted(r.date for r in found.collect()) == inside


@pytest.mark.parametrize("by", ["day", "year"])
def test_replacing_a_window_is_repeatable_and_leaves_the_rest(spark, database, by):
    days = [D(2023, 12, 30), D(2023, 12, 31), D(2024, 1, 1), D(2024, 1, 2)]
    table = made(spark, database, by, *days)
    new = rows_on(spark, *days, vtoll=9)
    for _ in range(2):
        window = D(2023, 12, 31), D(2024, 1, 2)
        assert replace_window(spark, table, new, *window) == 2
        assert content(spark, table) == [(days[0], 1), (days[1], 9), (days[2], 9), (days[3], 1)]


@pytest.mark.parametrize("by", ["day", "year"])
def test_days_without_new_rows_end_up_empty(spark, database, by):
    days = [D(2023, 12, 31), D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)]
    table = made(spark, database, by, *days)
    new = rows_on(spark, D(2024, 1, 2), vtoll=9)
    replace_window(spark, table, new, D(2023, 12, 31), D(2024, 1, 3))
    assert content(spark, table) == [(D(2024, 1, 2), 9), (D(2024, 1, 3), 1)]
    append(spark, table, rows_on(spark, D(2024, 1, 1)))
    assert spark.table(table.name).where("date = DATE'2024-01-01'").count() == 1


@pytest.mark.parametrize("by", ["day", "year"])
def test_replacing_with_nothing_empties_the_window(spark, database, by):
    table = made(spark, database, by, D(2023, 5, 1), None)
    year = D(2023, 1, 1), D(2024, 1, 1)
    assert replace_window(spark, table, rows_on(spark), *year) == 0
    assert content(spark, table) == [(None, 1)]
    one = rows_on(spark, D(2023, 1, 1))
    assert replace_window(spark, table, one, D(2023, 1, 1), D(2024, 1, 1)) == 1


@pytest.mark.parametrize("by", ["day", "year"])
def test_a_replacement_may_read_the_table_itself(spark, database, by):
    table = made(spark, database, by, D(2024, 1, 1), D(2024, 1, 2))
    changed = spark.table(table.name).withColumn("vehicles_vtoll", F.lit(2))
    day = D(2024, 1, 1), D(2024, 1, 2)
    replace_window(spark, table, changed.drop("date_year"), *day)
    assert content(spark, table) == [(D(2024, 1, 1), 2), (D(2024, 1, 2), 1)]


def test_a_window_without_days_is_refused(spark, database):
    table = made(spark, database, "day", D(2024, 1, 1))
    with pytest.raises(ValueError):
        replace_window(spark, table, rows_on(spark), D(2024, 1, 1), D(2024, 1, 1))


def test_the_overwrite_mode_of_the_session_does_not_matter(spark, database):
    setting = "spark.sql.sources.partitionOverwriteMode"
    table = made(spark, database, "day", D(2024, 1, 1), D(2024, 1, 5))
    other = made(spark, database, "day", D(2024, 1, 1), D(2024, 1, 5), name="other")
    rows = rows_on(spark, D(2024, 1, 1), vtoll=9)
    replace_window(spark, table, rows, D(2024, 1, 1), D(2024, 1, 2))
    assert content(spark, table) == [(D(2024, 1, 1), 9), (D(2024, 1, 5), 1)]
    # an overwrite of another table in the same session is static, as the session says
    spark.sql(
        f"INSERT OVERWRITE {other.name} PARTITION (date) BY NAME SELECT * FROM {{rows}}", rows=rows
    )
    assert content(spark, other) == [(D(2024, 1, 1), 9)]
    assert spark.conf.get(setting).lower() == "static"


@pytest.mark.parametrize("by", ["day", "year"])
def test_a_window_without_an_end(spark, database, by):
    days = [D(2022, 12, 31), D(2023, 1, 1), D(2024, 6, 1), None]
    table = made(spark, database, by, *days)
    new = rows_on(spark, D(2023, 5, 1), vtoll=9)
    assert replace_window(spark, table, new, D(2023, 1, 1)) == 1
    assert content(spark, table) == [(None, 1), (D(2022, 12, 31), 1), (D(2023, 5, 1), 9)]


def files_of(spark, table):
    found = spark.table(table.name).select("_metadata.file_path", "_metadata.file_size", "date")
    return {(r.file_path, r.file_size): r.date for r in found.collect()}


def test_files_outside_the_window_stay_as_they_are(spark, database):
    """Four appends are four files of a year; two hold days of the window."""
    table = made(spark, database, "year", D(2024, 1, 1), D(2024, 1, 2))
    for days in ([D(2024, 3, 1)], [D(2024, 3, 2), D(2024, 8, 1)], [D(2024, 8, 2)], [D(2023, 3, 1)]):
        append(spark, table, rows_on(spark, *days))
    before = files_of(spark, table)
    new = rows_on(spark, D(2024, 3, 2), D(2024, 3, 5), vtoll=9)
    assert replace_window(spark, table, new, D(2024, 3, 1), D(2024, 4, 1)) == 2
    assert content(spark, table) == [
        (D(2023, 3, 1), 1), (D(2024, 1, 1), 1), (D(2024, 1, 2), 1), (D(2024, 3, 2), 9),
        (D(2024, 3, 5), 9), (D(2024, 8, 1), 1), (D(2024, 8, 2), 1),
    ]
    after = files_of(spark, table)
    march = {f for f, day in before.items() if day.month == 3 and day.year == 2024}
    touched = {f for f in before if f[0] in {name for name, _ in march}}
    stay = {f for f, day in before.items() if day in (D(2023, 3, 1), D(2024, 8, 2), D(2024, 1, 1))}
    assert stay <= after.keys() and not (touched - stay) & after.keys()


def test_an_emptied_year_is_dropped_and_a_new_one_added(spark, database):
    table = made(spark, database, "year", D(2023, 5, 1), D(2024, 5, 1))
    replace_window(spark, table, rows_on(spark, D(2025, 1, 1)), D(2024, 1, 1), D(2026, 1, 1))
    shown = spark.sql(f"SHOW PARTITIONS {table.name}").collect()
    assert sorted(r.partition for r in shown) == ["date_year=2023", "date_year=2025"]
    assert content(spark, table) == [(D(2023, 5, 1), 1), (D(2025, 1, 1), 1)]


@pytest.mark.parametrize("step", ["write_lines", "move", "delete"])
def test_a_broken_swap_is_finished_or_never_happened(spark, database, monkeypatch, step):
    table = made(spark, database, "year", D(2024, 1, 1), D(2024, 1, 2), None)
    append(spark, table, rows_on(spark, D(2025, 1, 1)))
    window = D(2024, 1, 1), D(2025, 6, 1)
    new = rows_on(spark, D(2024, 1, 1), D(2026, 1, 1), vtoll=9)

    def broken(*args):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(swaps.files, step, broken)
        with pytest.raises(OSError, match="stopped"):
            replace_window(spark, table, new, *window)
    if step == "write_lines":  # not decided: nothing has changed
        days = D(2024, 1, 1), D(2024, 1, 2), D(2025, 1, 1)
        assert content(spark, table) == [(None, 1), *((day, 1) for day in days)]
    else:
        finish_replacements(spark, table)
        assert content(spark, table) == [(None, 1), (D(2024, 1, 1), 9)]
    for _ in range(2):
        assert replace_window(spark, table, new, *window) == 1
        assert content(spark, table) == [(None, 1), (D(2024, 1, 1), 9)]


def test_external_tables_are_not_replaced(spark, database, tmp_path):
    table = FeedTable(f"{database}.ext")
    spark.sql(f"{create_statement(table)} LOCATION '{tmp_path}/ext'")
    append(spark, table, rows_on(spark, D(2024, 1, 1)))
    with pytest.raises(ValueError):
        replace_window(spark, table, rows_on(spark), D(2024, 1, 1), D(2024, 1, 2))
    assert spark.table(table.name).count() == 1


def test_iceberg_statements_use_its_own_transform():
    by_year = create_statement(FeedTable("c.bronze.t", "year", "iceberg"))
    assert "PARTITIONED BY (years(date))" in by_year and "date_year" not in by_year
    assert "PARTITIONED BY (date)" in create_statement(FeedTable("c.bronze.t", "day", "iceberg"))


@pytest.mark.parametrize("by", ["day", "year"])
def test_a_day_with_most_rows_is_written_by_several_tasks(spark, database, conf, by):
    # sizes that are to this test's rows what the defaults are to a large load
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
    table = FeedTable(f"{database}.t", by)
    create_if_absent(spark, table)
    hot = F.when(F.col("id") % 3 == 0, F.expr("date_add(DATE'2024-01-01', cast(id % 28 as int))"))
    rows = spark.range(0, 200_000, numPartitions=16).select(
        F.col("id").cast("string").alias("plaza_id"),
        F.coalesce(hot, F.lit(D(2024, 1, 15))).alias("date"),
        F.lit("0").alias("hour"), F.lit("I").alias("direction"),
        F.lit(1).alias("vehicles_e_zpass"), F.lit(1).alias("vehicles_vtoll"),
    )
    assert append(spark, table, rows) == 200_000
    files = spark.table(table.name).where("date = DATE'2024-01-15'").inputFiles()
    assert len(files) > 1
    assert spark.table(table.name).count() == 200_000

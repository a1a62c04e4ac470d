import datetime

import pytest
from pyspark.sql import functions as F
from test_tables import files_of

from feedlake.plans import FeedTable, append, create_if_absent, newest_per_key, upsert
from feedlake.schema import TYPED_SCHEMA

D = datetime.date


def rows(spark, *keys, vtoll=1, revision=None):
    """Rows of (day, hour); with a `revision` column if one is given."""
    made = spark.createDataFrame([("21", d, h, "I", 1, vtoll) for d, h in keys], TYPED_SCHEMA)
    return made if revision is None else made.withColumn("revision", F.lit(revision))


def made(spark, database, by, *loads):
    table = FeedTable(f"{database}.t", by)
    create_if_absent(spark, table)
    for keys in loads:
        append(spark, table, rows(spark, *keys))
    return table


def content(spark, table):
    found = spark.table(table.name).select("date", "hour", "vehicles_vtoll").collect()
    return sorted(map(tuple, found), key=str)


A, B = (D(2023, 12, 31), "1"), (D(2024, 1, 1), "1")
C, E = (D(2024, 1, 1), "2"), (D(2025, 6, 1), "1")


@pytest.mark.parametrize("by", ["day", "year"])
def test_keys_are_replaced_or_added_and_it_can_be_repeated(spark, database, by):
    table = made(spark, database, by, [A, B, B, C])
    load = rows(spark, B, E, vtoll=9)
    report = upsert(spark, table, load)
    assert (report.n_rows, report.n_replaced) == (2, 2)
    want = [(*A, 1), (*B, 9), (*C, 1), (*E, 9)]
    assert content(spark, table) == want
    report = upsert(spark, table, load)
    assert (report.n_rows, report.n_replaced) == (2, 2)
    assert content(spark, table) == want


@pytest.mark.parametrize("by", ["day", "year"])
def test_files_without_a_key_of_the_load_stay(spark, database, by):
    table = made(spark, database, by, [A], [B, C], [(D(2024, 1, 1), "3")], [E])
    before = files_of(spark, table)
    upsert(spark, table, rows(spark, C, vtoll=9))
    gone = before.keys() - files_of(spark, table).keys()
    assert len(before) == 4 and len(gone) == 1
    assert content(spark, table) == [(*A, 1), (*B, 1), (*C, 9), (D(2024, 1, 1), "3", 1), (*E, 1)]


def test_the_newest_of_a_load_wins_whatever_the_order(spark):
    load = [rows(spark, B, C, vtoll=v, revision=r) for v, r in ((5, 2), (9, 1), (7, 2), (8, None))]
    load[3] = rows(spark, B, C, (D(2024, 1, 2), "0"), vtoll=8).withColumn("revision", F.lit(None))
    for some in (load, load[::-1]):
        union = some[0]
        for part in some[1:]:
            union = union.unionByName(part)
        found = newest_per_key(union.repartition(3), "revision").collect()
        assert sorted((r.date, r.hour, r.vehicles_vtoll) for r in found) == [
            (*B, 7), (*C, 7), (D(2024, 1, 2), "0", 8)
        ]


@pytest.mark.parametrize("by", ["day", "year"])
def test_keys_that_are_null_are_equal(spark, database, by):
    table = made(spark, database, by, [(None, "1"), (None, None), B])
    upsert(spark, table, rows(spark, (None, "1"), (D(2024, 1, 1), None), vtoll=9))
    assert sorted(content(spark, table), key=str) == sorted(
        [(None, "1", 9), (None, None, 1), (*B, 1), (D(2024, 1, 1), None, 9)], key=str
    )
    upsert(spark, table, rows(spark, (None, None), vtoll=9))
    assert (None, None, 9) in content(spark, table) and (*B, 1) in content(spark, table)


@pytest.mark.parametrize("by", ["day", "year"])
def test_empty_loads_and_tables(spark, database, by):
    table = made(spark, database, by)
    assert upsert(spark, table, rows(spark)).n_rows == 0
    assert upsert(spark, table, rows(spark, A, A, vtoll=3)).n_rows == 1
    assert upsert(spark, table, rows(spark)).n_rows == 0
    assert content(spark, table) == [(*A, 3)]


def test_batched_and_external_tables_are_refused(spark, database, tmp_path):
    with pytest.raises(ValueError):
        upsert(spark, FeedTable(f"{database}.b", batched=True), rows(spark, A))
    spark.sql(
        f"CREATE TABLE {database}.x (plaza_id string, hour string, direction string, "
        f"vehicles_e_zpass int, vehicles_vtoll int, date date) USING parquet "
        f"PARTITIONED BY (date) LOCATION '{tmp_path}/x'"
    )
    with pytest.raises(ValueError):
        upsert(spark, FeedTable(f"{database}.x"), rows(spark, A))

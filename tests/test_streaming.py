import json

from pyspark.sql import functions as F

from feedlake.plans import FeedTable, create_if_absent
from feedlake.schema import CORRUPT_COLUMN, WIRE_SCHEMA
from feedlake.sources import read_stage
from feedlake.streaming import (
    compact_batches,
    incremental,
    load_batch,
    load_new_files,
    report_new_rejects,
)


def drop(stage, name, hours, day="2024-01-01", vtoll="3"):
    stage.mkdir(exist_ok=True)
    rows = [("21", f"{day}T00:00:00.000", str(h), "I", "1", vtoll) for h in hours]
    lines = [json.dumps(dict(zip(WIRE_SCHEMA.names, row))) for row in rows]
    (stage / name).write_text("\n".join(lines))


def target(database):
    return FeedTable(f"{database}.t", batched=True)


def test_every_file_is_loaded_once(spark, tmp_path, database):
    stage, progress = tmp_path / "stage", str(tmp_path / "progress")
    table = target(database)

    def run():
        report = load_new_files(spark, str(stage), table, progress)
        return report.n_rows, spark.table(table.name).count()

    drop(stage, "a.json", range(5))
    assert [run(), run()] == [(5, 5), (0, 5)]
    drop(stage, "b.json", range(5), "2024-01-02")
    assert [run(), run()] == [(5, 10), (0, 10)]
    loaded = spark.table(table.name)
    assert loaded.select("date").distinct().count() == 2
    assert dict(loaded.dtypes)["vehicles_vtoll"] == "int"


def test_a_batch_that_runs_again_loads_once(spark, tmp_path, database):
    stage, table = tmp_path / "stage", target(database)
    create_if_absent(spark, table)
    drop(stage, "a.json", range(5))
    drop(stage, "b.json", range(3), "2024-01-02")
    wire = read_stage(spark, str(stage), keep_corrupt=True)
    for batch in (0, 0, 1, 1):
        assert load_batch(table, wire, batch).n_rows == 8
    counts = spark.table(table.name).groupBy("load_batch").agg(F.count("*").alias("n"))
    assert {r.load_batch: r.n for r in counts.collect()} == {0: 8, 1: 8}


def test_small_batches_load_the_same_rows(spark, tmp_path, database):
    stage, table = tmp_path / "stage", target(database)
    for i in range(5):
        drop(stage, f"{i}.json", [i])
    load_new_files(spark, str(stage), table, str(tmp_path / "progress"), max_files=2)
    assert sorted(r.hour for r in spark.table(table.name).collect()) == list("01234")


def test_rejects_are_counted_and_reported_once(spark, tmp_path, database):
    stage, sink, progress = tmp_path / "stage", str(tmp_path / "bad"), str(tmp_path / "progress")
    drop(stage, "a.json", [0], vtoll="12.7")
    drop(stage, "b.json", [1])
    (stage / "c.json").write_text('{"plaza_id": "2')
    for _ in range(2):
        report_new_rejects(spark, str(stage), sink, progress)
        found = spark.read.parquet(sink).collect()
        assert {(r.field, r.raw_value) for r in found} == {
            ("vehicles_vtoll", "12.7"), (CORRUPT_COLUMN, '{"plaza_id": "2')
        }
    report = load_new_files(spark, str(stage), target(database), str(tmp_path / "progress2"))
    assert (report.n_rows, report.n_bad_values, report.n_corrupt_lines) == (2, 1, 1)


def partitions(spark, table):
    shown = spark.sql(f"SHOW PARTITIONS {table.name}").collect()
    return sorted(r.partition.replace("load_batch=", "").replace("date=", "") for r in shown)


def hours(spark, table):
    return sorted(int(r.hour) for r in spark.table(table.name).collect())


def test_a_batch_lists_only_its_own_partitions(spark, tmp_path, database, monkeypatch):
    """The catalog learns of partitions by name: one that lies beside them unnamed stays unknown."""
    stage, table = tmp_path / "stage", target(database)
    drop(stage, "a.json", [0])
    load_new_files(spark, str(stage), table, str(tmp_path / "progress"))
    folder = spark.sql(f"DESCRIBE EXTENDED {table.name}").where("col_name = 'Location'").first()[1]
    spark.sql("SELECT 1 AS x").write.parquet(f"{folder}/date=2020-01-01/load_batch=7")
    drop(stage, "b.json", [1], "2024-01-02")
    load_new_files(spark, str(stage), table, str(tmp_path / "progress"))
    assert partitions(spark, table) == ["2024-01-01/0", "2024-01-02/1"]
    assert hours(spark, table) == [0, 1]


def test_folders_per_day_stay_bounded(spark, tmp_path, database):
    stage, table, progress = tmp_path / "stage", target(database), str(tmp_path / "progress")
    for k in range(7):
        drop(stage, f"{k}.json", [k])
        if k % 3 == 0:
            drop(stage, f"x{k}.json", [10 + k], "2024-01-02")
        drop(stage, f"n{k}.json", [20 + k], "n/a")
        load_new_files(spark, str(stage), table, progress, most_partitions=2)
        days = [p.split("/")[0] for p in partitions(spark, table)]
        assert max(map(days.count, days)) <= 2
    assert hours(spark, table) == [*range(7), 10, 13, 16, *range(20, 27)]
    assert spark.table(table.name).where("date is null").count() == 7
    compact_batches(spark, table, progress)
    assert len(partitions(spark, table)) == 3
    assert compact_batches(spark, table, progress) == 0
    assert hours(spark, table) == [*range(7), 10, 13, 16, *range(20, 27)]


def test_batches_that_may_be_repeated_are_not_merged(spark, tmp_path, database):
    stage, table, progress = tmp_path / "stage", target(database), str(tmp_path / "progress")
    assert compact_batches(spark, table, progress) == 0
    for k in range(2):
        drop(stage, f"{k}.json", [k])
        load_new_files(spark, str(stage), table, progress)
    wire = read_stage(spark, str(stage), keep_corrupt=True)
    load_batch(table, wire, 2)  # broke off before the checkpoint knew
    compact_batches(spark, table, progress)
    assert partitions(spark, table) == ["2024-01-01/-2", "2024-01-01/2"]
    load_batch(table, wire, 2)
    assert hours(spark, table) == [0, 0, 1, 1]


def test_a_broken_compaction_is_finished_by_the_next(spark, tmp_path, database, monkeypatch):
    stage, table, progress = tmp_path / "stage", target(database), str(tmp_path / "progress")
    for k in range(3):
        drop(stage, f"{k}.json", [k])
        load_new_files(spark, str(stage), table, progress)

    def broken(*args):
        raise OSError("stopped")

    for step in ("add_partitions", "drop_partitions"):
        with monkeypatch.context() as patch:
            patch.setattr(incremental, step, broken)
            try:
                compact_batches(spark, table, progress)
            except OSError:
                pass
    compact_batches(spark, table, progress)
    assert partitions(spark, table) == ["2024-01-01/-3"] and hours(spark, table) == [0, 1, 2]

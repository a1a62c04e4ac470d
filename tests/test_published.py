import pytest
from pyspark.sql import functions as F

from feedlake import files
from feedlake.schema import CORRUPT_COLUMN, WIRE_SCHEMA
from feedlake.sources import (
    drop_publications,
    publications,
    publish_stage,
    read_published,
)


def feed(spark, hours):
    day = "2023-04-10T00:00:00.000"
    return spark.createDataFrame(
        [("21", day, str(h), "I", "12", "3") for h in hours], WIRE_SCHEMA
    ).repartition(3)


def hours(frame):
    return sorted(int(row.hour) for row in frame.select("hour").collect())


def test_a_reader_during_a_rewrite_sees_the_stage_before(spark, tmp_path):
    stage = f"{tmp_path}/a stage"
    assert publish_stage(feed(spark, range(5)), stage) == 1
    opened = read_published(spark, stage)
    seen = []

    @F.udf("string")
    def slow(hour):
        return hour

    during = feed(spark, range(5, 9)).withColumn("hour", slow("hour"))
    write_lines = files.write_lines

    def reading(*given):  # all files are written, the manifest is not
        seen.append(hours(read_published(spark, stage)))
        write_lines(*given)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(files, "write_lines", reading)
        assert publish_stage(during, stage) == 2
    assert seen == [list(range(5))]
    assert hours(opened) == list(range(5))  # opened before, read after
    assert hours(read_published(spark, stage)) == list(range(5, 9))
    assert hours(read_published(spark, stage, number=1)) == list(range(5))


def test_a_failed_rewrite_is_never_seen(spark, tmp_path):
    stage = str(tmp_path / "stage")
    publish_stage(feed(spark, range(3)), stage)
    broken = feed(spark, range(9)).withColumn("hour", F.expr("CAST(raise_error('lost') AS string)"))
    with pytest.raises(Exception, match="lost"):
        publish_stage(broken, stage)
    assert publications(spark, stage) == [1]
    assert hours(read_published(spark, stage)) == [0, 1, 2]
    assert publish_stage(feed(spark, [7]), stage) == 2
    assert hours(read_published(spark, stage)) == [7]


def test_a_stage_can_be_published_from_itself(spark, tmp_path):
    stage = str(tmp_path / "stage")
    publish_stage(feed(spark, range(6)), stage)
    publish_stage(read_published(spark, stage).where("CAST(hour AS int) % 2 = 0"), stage)
    assert hours(read_published(spark, stage)) == [0, 2, 4]


def test_empty_and_absent_stages(spark, tmp_path):
    stage = str(tmp_path / "stage")
    with pytest.raises(FileNotFoundError):
        read_published(spark, stage)
    publish_stage(spark.createDataFrame([], WIRE_SCHEMA), stage)
    empty = read_published(spark, stage, keep_corrupt=True)
    assert empty.columns == [*WIRE_SCHEMA.names, CORRUPT_COLUMN] and empty.isEmpty()
    with pytest.raises(FileNotFoundError):
        read_published(spark, stage, number=2)


def test_old_publications_and_remains_go(spark, tmp_path):
    stage = str(tmp_path / "stage")
    for n in range(1, 5):
        publish_stage(feed(spark, range(n)), stage)
    feed(spark, [1]).write.json(f"{stage}/data-broken")  # written, but never listed
    assert drop_publications(spark, stage, keep=2) == 2
    assert publications(spark, stage) == [3, 4]
    folders = [n for n in files.names_in(spark, stage) if n.startswith("data-")]
    assert len(folders) == 2 and "data-broken" not in folders
    assert hours(read_published(spark, stage, number=3)) == [0, 1, 2]
    assert publish_stage(feed(spark, [5]), stage) == 5
    with pytest.raises(ValueError):
        drop_publications(spark, stage, keep=0)

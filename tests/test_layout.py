import pytest
from pyspark.sql import functions as F

from feedlake.operators import deep_limit_offset, limit_offset, page_counts
from feedlake.sources import layout as layout_module
from feedlake.sources import rows_between, with_offsets, write_layout
from feedlake.workspace import scratch_path


def numbers(spark, total):
    days = F.expr("date_add(DATE'2024-01-01', cast(id % 5 as int))")
    return spark.range(total).select(F.col("id").alias("n"), days.alias("day"))


def laid(spark, frame, keys):
    return write_layout(frame, keys, scratch_path(spark, "test"))


@pytest.fixture
def many_files(conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_large_inputs_get_more_ranges_than_the_session_has_partitions(spark, monkeypatch):
    monkeypatch.setattr(layout_module, "ROWS_PER_RANGE", 50)
    layout = laid(spark, numbers(spark, 1000), ["n"])
    assert 8 < spark.read.parquet(layout.files_path).count() <= 20
    assert with_offsets(spark, layout).where("n <> row_offset").count() == 0


def test_offsets_follow_the_order(spark, many_files):
    frame = numbers(spark, 1000).withColumn("n", F.lit(999) - F.col("n"))
    layout = laid(spark, frame, ["n"])
    rows = with_offsets(spark, layout)
    assert rows.where("n <> row_offset").count() == 0
    assert rows.count() == 1000
    assert spark.read.parquet(layout.files_path).count() > 1


def test_one_key_for_all_rows_is_still_cut_into_ranges(spark, many_files):
    frame = spark.range(20_000).select(F.lit(7).alias("key"), (F.col("id") % 3).alias("v"))
    layout = laid(spark, frame, ["key"])
    sizes = [r.n_rows for r in spark.read.parquet(layout.files_path).collect()]
    assert sum(sizes) == 20_000
    assert max(sizes) < 10_000
    offsets = with_offsets(spark, layout).select("row_offset").distinct()
    assert (offsets.count(), *offsets.agg(F.min("row_offset"), F.max("row_offset")).first()) == (
        20_000, 0, 19_999
    )


def test_files_of_a_range_keep_their_order(spark, many_files, conf):
    conf("spark.sql.files.maxRecordsPerFile", "17")
    layout = laid(spark, numbers(spark, 500), ["n"])
    assert spark.read.parquet(layout.files_path).count() > 16
    assert with_offsets(spark, layout).where("n <> row_offset").count() == 0


@pytest.mark.parametrize("lo, hi", [(0, 1), (0, 1000), (499, 503), (990, 2000), (1000, 1010)])
def test_rows_between(spark, many_files, lo, hi):
    layout = laid(spark, numbers(spark, 1000), ["n"])
    found = [r.n for r in rows_between(spark, layout, lo, hi).collect()]
    assert found == list(range(lo, min(hi, 1000)))


@pytest.mark.parametrize("total", [0, 1, 100, 1001])
def test_page_counts(spark, total):
    pages = {r.page: r.n_rows for r in page_counts(numbers(spark, total), 100).collect()}
    left = {total // 100: total % 100} if total % 100 else {}
    assert pages == dict.fromkeys(range(total // 100), 100) | left


def awkward(spark, total):
    """Columns named like the helpers of a layout, one with a dot, and a map."""
    return spark.range(total).select(
        (F.col("id") * 7 % total).alias("row"),
        F.col("id").alias("file"),
        F.col("id").alias("first_row"),
        F.col("id").alias("row_offset"),
        F.col("id").alias("_row_index"),
        F.col("id").alias("part"),
        F.col("id").alias("key"),
        F.col("id").alias("a.b"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"),
    )


@pytest.mark.parametrize("limit, offset", [(5, 0), (10, 95), (10, 20_000), (10, 20_006), (0, 3)])
def test_limit_and_offset_at_any_depth(spark, limit, offset):
    frame = awkward(spark, 20_011)
    rows = sorted(frame.collect(), key=lambda r: r["row"])
    for find in (limit_offset, deep_limit_offset):
        found = find(frame, ["row"], limit, offset)
        assert found.columns == frame.columns
        assert found.collect() == rows[offset : offset + limit]


def test_a_dotted_key_and_ties(spark):
    frame = awkward(spark, 50).withColumn("row", F.lit(1))
    by_dot = [r["a.b"] for r in limit_offset(frame, ["a.b"], 5, 10).collect()]
    assert by_dot == [10, 11, 12, 13, 14]
    shallow = limit_offset(frame, ["row"], 20, 7).collect()
    assert shallow == deep_limit_offset(frame, ["row"], 20, 7).collect()


def test_an_offset_column_that_is_taken_is_refused(spark):
    layout = laid(spark, awkward(spark, 5), ["row"])
    with pytest.raises(ValueError):
        with_offsets(spark, layout)
    assert with_offsets(spark, layout, "at").count() == 5


def test_an_empty_layout(spark):
    layout = laid(spark, numbers(spark, 0), ["n"])
    assert with_offsets(spark, layout).count() == 0
    assert rows_between(spark, layout, 0, 10).count() == 0

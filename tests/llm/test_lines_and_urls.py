import datetime
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import duck, same  # noqa: E402

from feedlake.llm.line_dedup import without_boilerplate  # noqa: E402
from feedlake.llm.queries import ORACLES, QUERIES  # noqa: E402
from feedlake.llm.url_filters import filtered_captures, intervals  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
D = datetime.date


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert same(QUERIES[name](spark, SF_DIR), ORACLES[name], duck(SF_DIR)) is None


@pytest.mark.parametrize("name", ["op5_line_dedup", "op6_url_filters"])
def test_plans_are_native(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_boilerplate_is_relative_to_the_host(spark):
    pages = [("big", f"menu \n\nstory {i}\n  menu") for i in range(100)]
    pages += [("big", "rare\nonly")] * 60 + [("small", f"menu\nown {i}") for i in range(4)]
    docs = spark.createDataFrame(pages, "source string, text string")
    rows = without_boilerplate(docs).collect()
    big = [r for r in rows if r.text.startswith("\nstory")]
    assert len(big) == 100 and all(r.n_dropped == 2 for r in big)
    # sixty copies are one page, and four pages are too few to tell
    assert sum(r.text == "rare\nonly" for r in rows) == 60
    assert sum(r.text.startswith("menu\nown") for r in rows) == 4


def test_awkward_rows(spark, awkward, empty):
    cleaned = without_boilerplate(awkward, least_pages=1)
    assert set(cleaned.columns) == set(awkward.columns)
    rows = {(r.doc_id, r.text, r.n_dropped) for r in cleaned.collect()}
    assert (1, None, 0) in rows and (2, "", 0) in rows and (3, " \n\t ", 0) in rows
    assert cleaned.count() == 9 and without_boilerplate(empty).count() == 0
    other = without_boilerplate(awkward, least_pages=1, dropped="gone")
    own = other.select("n_dropped", "_lines", "_host", "`a.b`").distinct().collect()
    assert [tuple(r) for r in own] == [("own",) * 4]
    captures = awkward.withColumn("url", F.lit("http://a.b/")).withColumn(
        "fetched_on", F.lit("2024-01-02").cast("date")
    )
    entries = spark.createDataFrame([("a.b", D(2024, 1, 1), "block")],
                                    "pattern string, listed_on date, action string")
    found = filtered_captures(captures, entries)
    own = found.select("blocked", "host", "_host", "_day", "of_host", "`a.b`").distinct().collect()
    assert [tuple(r) for r in own] == [(True, "a.b", "own", "own", "own", "own")]


def captured(spark, rows, entries):
    captures = spark.createDataFrame(rows, "url string, fetched_on date")
    found = filtered_captures(
        captures, spark.createDataFrame(entries, "pattern string, listed_on date, action string")
    )
    return {(r.url, r.fetched_on): (r.pattern, r.action, r.blocked) for r in found.collect()}


def test_a_capture_meets_the_entries_of_its_day(spark):
    entries = [
        ("Example.com", D(2024, 1, 10), "block"), ("example.com", D(2025, 3, 1), "remove"),
        ("good.example.com", D(2024, 2, 1), "allow"), ("b.org", D(2024, 5, 5), "block"),
        ("b.org", D(2024, 5, 5), "allow"), (None, D(2024, 1, 1), "block"), ("c.org", None, "block"),
    ]
    days = [D(2024, 1, 9), D(2024, 1, 10), D(2024, 2, 1), D(2025, 2, 28), D(2025, 3, 1)]
    urls = ["http://u:p@GOOD.example.com.:80/x", "https://example.com?q", "http://notexample.com/"]
    found = captured(spark, [(u, d) for u in urls for d in days], entries)
    block, allow = ("example.com", "block", True), ("good.example.com", "allow", False)
    none = (None, None, False)
    assert [found[urls[0], d] for d in days] == [none, block, allow, allow, allow]
    assert [found[urls[1], d] for d in days] == [none, block, block, block, none]
    assert [found[urls[2], d] for d in days] == [none] * 5
    odd = [(None, days[1]), ("nonsense", days[1]), ("http://b.org", None), ("http://b.org", days[4])]
    found = captured(spark, odd + odd, entries)
    assert list(found.values()) == [none, none, none, ("b.org", "allow", False)] or (
        found["http://b.org", days[4]] == ("b.org", "allow", False) and len(found) == 4
    )


def test_a_pattern_of_one_label_covers_its_subdomains(spark):
    day = D(2024, 1, 2)
    hosts = ["a.b.example", "b.example", "example", "notexample", "example.org"]
    entries = [("example", D(2024, 1, 1), "block"), ("b.example", D(2024, 1, 1), "allow")]
    found = captured(spark, [(f"http://{h}/", day) for h in [*hosts, "c.example"]], entries)
    block, allow = ("example", "block", True), ("b.example", "allow", False)
    none = (None, None, False)
    assert [found[f"http://{h}/", day] for h in hosts] == [allow, allow, block, none, none]
    assert found["http://c.example/", day] == block


def test_no_captures_and_no_entries(spark):
    assert captured(spark, [], [("a.b", D(2024, 1, 1), "block")]) == {}
    found = captured(spark, [("http://a.b", D(2024, 1, 1))], [])
    assert list(found.values()) == [(None, None, False)]
    entries = spark.createDataFrame([], "pattern string, listed_on date, action string")
    assert intervals(entries).count() == 0


def test_captures_keep_their_other_columns(spark):
    captures = spark.range(3).select(
        F.lit("http://a.b/").alias("url"), F.lit("2024-01-01").cast("date").alias("fetched_on"),
        F.lit("own").alias("slot"), F.lit("own").alias("pattern"), F.lit(1).alias("x.y"),
    )
    entries = spark.createDataFrame([("a.b", D(2023, 1, 1), "block")],
                                    "pattern string, listed_on date, action string")
    rows = filtered_captures(captures, entries).collect()
    assert len(rows) == 3 and all((r.slot, r["x.y"], r.blocked) == ("own", 1, True) for r in rows)

import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm.warc import MAGIC, archived, read_archives, records_in, with_roles, write_archives
from feedlake.workspace import scratch_path

SCHEMA = "page_id bigint, url string, html string"
BIG = "é" * 600


def pages():
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i * 13 % 90)) for i in range(120)]
    rows += [(200 + i, "http://h/copy", BIG) for i in range(40)] + [(239, "http://h/again", BIG)]
    rows += [(300 + i, "http://h/small", "s" * 999) for i in range(3)]
    rows += [(400, None, None), (401, "", ""), (402, "http://h/a b\r\nX: y", "t"),
             (None, "http://h", BIG), (403, "http://h", "u" * 1000), (404, "", "v" * 300_000)]
    return rows


def expected(rows):
    best = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page is not None:
            best[body] = max(best.get(body, page), page)
    result = []
    for page, _, html in rows:
        body = (html or "").encode()
        keeper = best.get(body)
        revisit = keeper is not None and page != keeper
        role = ("revisit", keeper) if revisit else ("response", None)
        result.append((page, len(body), hashlib.sha1(body).hexdigest(), *role))
    return sorted(result, key=str)


def digest(frame):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, frame.select(*columns).collect()), key=str)


@pytest.mark.parametrize("range_bytes", [97, 4096, 32 << 20])
def test_archives_say_what_was_written(spark, range_bytes):
    rows = pages()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    files = write_archives(with_roles(frame), scratch_path(spark, "warc"), file_bytes=1_500)
    assert files.count() > 3 and files.agg({"n_records": "sum"}).first()[0] == len(rows)
    back = read_archives(spark, files, range_bytes)
    assert digest(back) == expected(rows)
    held = {r.page_id: r.payload for r in back.where("record_type = 'response'").collect()}
    assert held[404] == b"v" * 300_000 and held[402] == b"t" and held[239] == BIG.encode()
    assert back.where("page_id = 402").first().url == "http://h/a%20b%0D%0AX:%20y"
    for path in [r.path for r in files.limit(2).collect()]:
        with gzip.open(path.removeprefix("file:")) as file:
            assert file.read().startswith(b"WARC/1.1\r\n")


def member(number, padding=b""):
    return gzip.compress(b"WARC/1.1\r\nn: %d\r\n\r\n" % number + padding, mtime=0)


@settings(deadline=None)
@given(
    st.lists(st.sampled_from([b"", b"x" * 40, MAGIC * 9, gzip.compress(b"no record")]), max_size=8),
    st.lists(st.integers(0, 700), max_size=5),
    st.sampled_from([b"", MAGIC, gzip.compress(b"neither")]),
)
def test_each_record_is_owned_by_one_range(paddings, cuts, noise):
    # stored, not deflated, so that the paddings' magic bytes are in the file
    parts = [member(i, p) for i, p in enumerate(paddings)]
    body = noise + noise.join(parts) + noise
    bounds = sorted({0, *(c for c in cuts if c < len(body)), len(body)})
    found = []
    for start, stop in zip(bounds[:-1], bounds[1:]):
        found += records_in(io.BytesIO(body), start, stop)
    assert found == [gzip.decompress(p) for p in parts]


def test_a_cut_off_file_gives_its_whole_records():
    body = member(1) + member(2)
    assert len(list(records_in(io.BytesIO(body[:-5]), 0, len(body)))) == 1


def test_no_pages(spark):
    assert archived(spark.createDataFrame([], SCHEMA)).count() == 0

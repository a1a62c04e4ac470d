"""Paged feeds as a Spark data source: pages are fetched by tasks, in parallel.

A feed answers two questions: how many rows a window of days has, and which rows lie at an
offset of it. The driver asks the first once, cuts the rows into runs of pages and hands one run
to each task; no page passes through the driver.

A feed that can go on after a key (`SeekFeed`) is asked for how many rows each range of keys has;
a task then reads its ranges by the last key it has seen, which rows that arrive meanwhile do not
shift. As a stream, a feed is read day by day: the checkpoint holds the day that is read up to.
"""

from __future__ import annotations

import datetime
import json
import math
import sys
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

# Fixed value: rows per page unless the caller says otherwise.
DEFAULT_PAGE_SIZE = 100_000

# A task reads about this many rows, unless the caller bounds the number of tasks.
ROWS_PER_RUN = 1_000_000

# Lets a range on the day column reach the feed; without it Spark filters after the scan.
PUSHDOWN_SETTING = "spark.sql.python.filterPushdown.enabled"

ONE_DAY = datetime.timedelta(days=1)


@dataclass(frozen=True)
class Bounds:
    """What a caller says of the requests: rows per page, and how many tasks there may be."""

    page_size: int = DEFAULT_PAGE_SIZE
    min_runs: int = 1
    max_runs: int | None = None


class Feed(ABC):
    """Something that is read by runs, one for each task. Instances are pickled to the tasks."""

    # whether pages of a window are numbered
    numbered = False

    def __init__(self, schema: StructType, day_column: str | None = None):
        self.schema = schema
        self.day_column = day_column

    @abstractmethod
    def runs(self, start: datetime.date | None, stop: datetime.date | None, bounds: Bounds) -> list:
        """What each task reads of the window; asked once, on the driver."""

    @abstractmethod
    def read_run(
        self,
        start: datetime.date | None,
        stop: datetime.date | None,
        run,
        bounds: Bounds,
        columns: list[str],
    ) -> Iterator[pa.RecordBatch]:
        """The rows of a run; asked in the tasks."""


class PagedFeed(Feed):
    """A feed that is read by limit and offset; its runs are `(offset, rows)`."""

    numbered = True

    @abstractmethod
    def count(self, start: datetime.date | None, stop: datetime.date | None) -> int:
        """Rows of the window; asked once, on the driver."""

    @abstractmethod
    def rows(
        self,
        start: datetime.date | None,
        stop: datetime.date | None,
        offset: int,
        n_rows: int,
        page_size: int,
        columns: list[str],
    ) -> Iterator[pa.RecordBatch]:
        """Rows `[offset, offset + n_rows)` of the window; asked in the tasks."""

    def runs(self, start, stop, bounds) -> list[tuple[int, int]]:
        total = self.count(start, stop)
        return page_runs(total, bounds.page_size, bounds.min_runs, bounds.max_runs)

    def read_run(self, start, stop, run, bounds, columns) -> Iterator[pa.RecordBatch]:
        at, n_rows = run
        left = n_rows
        for batch in self.rows(start, stop, at, n_rows, bounds.page_size, columns):
            left -= batch.num_rows
            yield batch
        if left:
            raise ValueError(f"feed ended {left} rows before the end of the run of {n_rows}")


class RequestFeed(PagedFeed):
    """A feed behind two functions of the caller, typically requests to a web service.

    `count_rows(start, stop)` returns a number, `fetch(start, stop, limit, offset)` a list of
    dicts. A page that fails, or that is not a list of exactly the rows asked for, fails the
    read: a short page would otherwise pass for the end of the feed.
    """

    def __init__(
        self,
        schema: StructType,
        count_rows: Callable[..., int],
        fetch: Callable[..., list[dict]],
        day_column: str | None = None,
    ):
        super().__init__(schema, day_column)
        self._count_rows = count_rows
        self._fetch = fetch

    def count(self, start, stop) -> int:
        return self._count_rows(start, stop)

    def rows(self, start, stop, offset, n_rows, page_size, columns) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(StructType([self.schema[c] for c in columns]))
        for at in range(offset, offset + n_rows, page_size):
            limit = min(page_size, offset + n_rows - at)
            page = self._fetch(start, stop, limit, at)
            _require_records(page, f"at offset {at}")
            if len(page) != limit:
                raise ValueError(f"page at offset {at} has {len(page)} rows instead of {limit}")
            yield _record_batch(page, arrow)


class SeekFeed(Feed):
    """A feed whose rows have a key that orders them, and that can go on after a key.

    `key` names the columns of the key; no two rows share it, and none of its parts is null.
    `histogram(start, stop)` returns a list of `(low, rows)`: the first key, or the first parts of
    it, of each range of keys in the window, in order, and about how many rows the range has. So a
    day with much of the data can be given as several ranges. `fetch(start, stop, low, high, after,
    limit)` returns the first `limit` records of the window in key order whose keys are at least
    `low`, below `high` and after `after`, as dicts; each of the three may be None, which is no
    bound.

    Rows that are there when the read begins are read once, whatever arrives meanwhile; those that
    arrive behind a task's last key are left to the next read. A page that is out of order, repeats
    a key or is not a list of records fails the read.
    """

    def __init__(
        self,
        schema: StructType,
        key: list[str],
        histogram: Callable[..., list[tuple[tuple, int]]],
        fetch: Callable[..., list[dict]],
        day_column: str | None = None,
    ):
        super().__init__(schema, day_column)
        self.key = key
        self._histogram = histogram
        self._fetch = fetch

    def runs(self, start, stop, bounds) -> list[tuple]:
        return key_runs(self._histogram(start, stop), bounds.min_runs, bounds.max_runs)

    def read_run(self, start, stop, run, bounds, columns) -> Iterator[pa.RecordBatch]:
        low, high = run
        arrow = to_arrow_schema(StructType([self.schema[c] for c in columns]))
        after = None
        while True:
            page = self._fetch(start, stop, low, high, after, bounds.page_size)
            _require_records(page, f"after {after}")
            for record in page:
                key = tuple(record[c] for c in self.key)
                if after is not None and key <= after:
                    raise ValueError(f"page after {after} goes back to {key}")
                after = key
            if page:
                yield _record_batch(page, arrow)
            if len(page) < bounds.page_size:
                return


def key_runs(
    histogram: list[tuple[tuple, int]], min_runs: int, max_runs: int | None = None
) -> list[tuple]:
    """Neighbouring ranges of keys as runs `(low, high)`, each of about as many rows.

    The first has no low and the last no high bound, so that no row falls between them.
    """
    total = sum(rows for _, rows in histogram)
    wanted = max(math.ceil(total / ROWS_PER_RUN), min_runs, 1)
    per_run = max(1, math.ceil(total / min(wanted, max_runs or wanted)))
    lows, held = [], 0
    for low, rows in histogram:
        if not lows or (rows and held >= per_run * len(lows)):
            lows.append(low)
        held += rows
    edges = [None, *lows[1:], None]
    return list(zip(edges[:-1], edges[1:])) if lows else []


def _require_records(page, where: str) -> None:
    if not isinstance(page, list) or not all(isinstance(row, dict) for row in page):
        raise ValueError(f"page {where} is no list of records: {str(page)[:200]}")


def _record_batch(page: list[dict], arrow: pa.Schema) -> pa.RecordBatch:
    """Records as Arrow columns; a missing field is NULL, an undeclared one is left out."""

    def text(value):
        return value if value is None or isinstance(value, str) else json.dumps(value)

    arrays = []
    for field in arrow:
        values = [row.get(field.name) for row in page]
        if pa.types.is_string(field.type):
            values = [text(v) for v in values]
        arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def page_runs(
    total: int, page_size: int, min_runs: int, max_runs: int | None = None
) -> list[tuple[int, int]]:
    """Cut `total` rows into runs `(offset, rows)` of whole pages, one run per task."""
    pages = math.ceil(total / page_size)
    wanted = max(math.ceil(total / ROWS_PER_RUN), min_runs, 1)
    wanted = min(wanted, max_runs or wanted)
    per_run = max(1, math.ceil(pages / wanted)) * page_size
    return [(at, min(per_run, total - at)) for at in range(0, total, per_run)]


class _Requests:
    """What readers have in common: the options, and rows of runs as the asked columns."""

    def __init__(self, feed: Feed, options: dict[str, str], schema: StructType):
        self.feed = feed
        self.schema = schema
        self.start = _day(options.get("start"))
        self.stop = _day(options.get("stop"))
        self.bounds = Bounds(
            int(options.get("pagesize", DEFAULT_PAGE_SIZE)),
            int(options.get("minruns", 1)),
            int(options.get("maxruns", 0)) or None,
        )
        self.page_column = options.get("pagecolumn")
        if self.bounds.page_size < 1:
            raise ValueError(f"page size must be positive, not {self.bounds.page_size}")
        if self.page_column and not feed.numbered:
            raise ValueError("a feed that is read by key has no page numbers")

    def runs(self, start, stop) -> list[InputPartition]:
        no_days = start is not None and stop is not None and start >= stop
        runs = [] if no_days else self.feed.runs(start, stop, self.bounds)
        # Spark wants at least one partition
        return [InputPartition((start, stop, run)) for run in runs or [None]]

    def rows(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        columns = [name for name in self.schema.names if name != self.page_column]
        start, stop, run = partition.value
        if run is None:
            return
        at = run[0]
        for batch in self.feed.read_run(start, stop, run, self.bounds, columns):
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            if self.page_column:
                pages = np.arange(at, at + batch.num_rows, dtype="int64") // self.bounds.page_size
                arrays.append(pa.array(pages))
                at += batch.num_rows
            arrays = [a.cast(f.type) for a, f in zip(arrays, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)


class PagedReader(_Requests, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.runs(self.start, self.stop)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.rows(partition)


class PagedStreamReader(_Requests, DataSourceStreamReader):
    """A feed as a stream of days; an offset is the day that is read up to, which is not in it.

    The option `start` is the first day of a new stream, `stop` the day that is complete up to now.
    """

    def __init__(self, feed: Feed, options: dict[str, str], schema: StructType):
        super().__init__(feed, options, schema)
        if self.start is None or self.stop is None:
            raise ValueError("a stream of a feed needs its first day and the one to read up to")

    def initialOffset(self) -> dict:
        return {"day": self.start.isoformat()}

    def latestOffset(self) -> dict:
        return {"day": max(self.start, self.stop).isoformat()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.runs(_day(start["day"]), _day(end["day"]))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.rows(partition)


class PushingReader(PagedReader):
    """A reader that asks the feed for the days a query is filtered to.

    Not used with a page column: page numbers belong to the window the options ask for.
    """

    def pushFilters(self, filters: list[Filter]):
        # Spark does not look again at a filter that is not handed back
        for item in filters:
            if not self._narrow(item):
                yield item

    def _narrow(self, item: Filter) -> bool:
        """Tighten the window by a comparison of the day column with a day."""
        if getattr(item, "attribute", None) != (self.feed.day_column,):
            return False
        day = getattr(item, "value", None)
        if not isinstance(day, datetime.date) or isinstance(day, datetime.datetime):
            return False
        if day == datetime.date.max:
            return False
        if isinstance(item, (GreaterThanOrEqual, GreaterThan, EqualTo)):
            low = day + ONE_DAY if isinstance(item, GreaterThan) else day
            self.start = low if self.start is None else max(self.start, low)
        if isinstance(item, (LessThan, LessThanOrEqual, EqualTo)):
            high = day if isinstance(item, LessThan) else day + ONE_DAY
            self.stop = high if self.stop is None else min(self.stop, high)
        return isinstance(
            item, (GreaterThanOrEqual, GreaterThan, LessThan, LessThanOrEqual, EqualTo)
        )


def _day(text: str | None) -> datetime.date | None:
    return datetime.date.fromisoformat(text) if text else None


def register_feed(spark: SparkSession, name: str, feed: Feed) -> None:
    """Make `feed` readable as `spark.read.format(name)`, and as `spark.readStream.format(name)`.

    Options: `start`, `stop` (days), `pageSize`, `columns` (comma-separated), `pageColumn` (adds
    the page number under that name), `minRuns` and `maxRuns` (bounds on the number of tasks)
    and `pushdown` (`false` where `spark.sql.python.filterPushdown.enabled` is off). The session's
    settings stay as they are: switch that one on to let filters on the day column reach the feed.
    """

    class RegisteredFeed(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            columns = self.options.get("columns")
            names = columns.split(",") if columns else feed.schema.names
            fields = [feed.schema[c] for c in names]
            if self.options.get("pageColumn"):
                fields.append(StructField(self.options["pageColumn"], LongType()))
            return StructType(fields)

        def streamReader(self, schema):
            return PagedStreamReader(feed, self._lowered(), schema)

        def _lowered(self):
            return {key.lower(): value for key, value in self.options.items()}

        def reader(self, schema):
            options = self._lowered()
            pushes = options.get("pushdown", "true") == "true" and not options.get("pagecolumn")
            return (PushingReader if pushes else PagedReader)(feed, options, schema)

    # tasks get this module with the feed, so that it need not be installed on the executors
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(RegisteredFeed)


def read_feed(
    spark: SparkSession,
    name: str,
    start: datetime.date | None = None,
    stop: datetime.date | None = None,
    page_size: int = DEFAULT_PAGE_SIZE,
    columns: list[str] | None = None,
    page_column: str | None = None,
    max_tasks: int | None = None,
) -> DataFrame:
    """Rows of a registered feed; the window goes to the feed with the request.

    `max_tasks` bounds how many tasks there are, and so how many requests a service sees at a time.
    """
    reader = spark.read.format(name).option("pageSize", page_size)
    reader = reader.option("minRuns", spark.sparkContext.defaultParallelism)
    if max_tasks is not None:
        reader = reader.option("maxRuns", max_tasks)
    reader = reader.option("pushdown", spark.conf.get(PUSHDOWN_SETTING, "false"))
    if start is not None:
        reader = reader.option("start", start.isoformat())
    if stop is not None:
        reader = reader.option("stop", stop.isoformat())
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if page_column:
        reader = reader.option("pageColumn", page_column)
    return reader.load()

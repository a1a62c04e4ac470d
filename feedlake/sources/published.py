"""A JSON stage that readers never see half written.

Each publication writes its files into a folder of its own and then one manifest, which lists them.
The manifest appears whole, and a stage is what its newest manifest lists. So a reader sees the
publication before or the one after, a write that fails is never seen, and rows read lazily stay
those of the publication that they were opened from. One publisher at a time.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedlake import files
from feedlake.schema import WIRE_SCHEMA
from feedlake.sources.staged import read_stage, staged_schema

_MANIFEST = "manifest-"
_DATA = "data-"


def publish_stage(df: DataFrame, path: str) -> int:
    """Make the rows of `df` the stage at `path`; returns the publication's number, from 1 on.

    `df` may read the stage that it replaces. The files of earlier publications stay, until
    `drop_publications`.
    """
    spark = df.sparkSession
    number = max(publications(spark, path), default=0) + 1
    folder = files.child(spark, path, f"{_DATA}{uuid.uuid4().hex}")
    df.write.json(unquote(folder))
    inner = folder.rpartition("/")[2]
    names = [n for n in files.names_in(spark, folder) if not n.startswith(("_", "."))]
    manifest = files.child(spark, path, _manifest(number))
    files.write_lines(spark, manifest, [f"{inner}/{name}" for name in sorted(names)])
    return number


def publications(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the stage's publications, oldest first; none if nothing was published."""
    names = files.names_in(spark, path)
    return sorted(int(n.removeprefix(_MANIFEST)) for n in names if n.startswith(_MANIFEST))


def read_published(
    spark: SparkSession,
    path: str,
    schema: StructType = WIRE_SCHEMA,
    keep_corrupt: bool = False,
    number: int | None = None,
) -> DataFrame:
    """Rows of the newest publication, or of the one with `number`, as `read_stage` gives them.

    A publication without rows is empty; a number that is not there, or no longer, is an error.
    """
    if number is None:
        number = max(publications(spark, path), default=0)
    listed = files.read_lines(spark, files.child(spark, path, _manifest(number)))
    if listed is None:
        raise FileNotFoundError(f"{path} has no publication {number or ''}".rstrip())
    if not listed:
        return spark.createDataFrame([], staged_schema(schema) if keep_corrupt else schema)
    paths = [unquote(files.child(spark, path, name)) for name in listed]
    return read_stage(spark, paths, schema, keep_corrupt)


def drop_publications(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest `keep` publications, and what broken ones left; returns how many.

    A manifest goes before its files, so that nothing opens what is being deleted. Readers that
    opened a deleted publication before fail; keep as many as they may be behind.
    """
    if keep < 1:
        raise ValueError("the newest publication stays")
    numbers = publications(spark, path)
    old, held = numbers[:-keep], set()
    for number in old:
        files.delete(spark, files.child(spark, path, _manifest(number)))
    for number in numbers[-keep:]:
        listed = files.read_lines(spark, files.child(spark, path, _manifest(number)))
        held |= {name.split("/", 1)[0] for name in listed}
    for name in files.names_in(spark, path):
        # a publication without rows lists no file, so its folder goes too: nothing reads it
        if name.startswith(_DATA) and name not in held:
            files.delete(spark, files.child(spark, path, name))
    return len(old)


def _manifest(number: int) -> str:
    return f"{_MANIFEST}{number:010d}"

"""The JSON stage: a directory of files with one record per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedlake.schema import CORRUPT_COLUMN, WIRE_SCHEMA


def staged_schema(schema: StructType = WIRE_SCHEMA) -> StructType:
    """The declared schema plus the column that keeps a line that is no JSON object."""
    return StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])


def write_stage(df: DataFrame, path: str) -> None:
    """Replace the stage at `path` with the rows of `df`; every task writes its own file."""
    df.write.mode("overwrite").json(path)


def read_stage(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = WIRE_SCHEMA,
    keep_corrupt: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Staged rows of a folder or of files, with a declared schema: nothing is inferred and an absent column is NULL.

    A file with one JSON array on a line reads as its rows, but one task parses it. A document
    spread over lines needs `multiline=True`. `keep_corrupt` adds the text of unreadable lines,
    which otherwise read as rows of NULLs.
    """
    declared = staged_schema(schema) if keep_corrupt else schema
    return spark.read.schema(declared).option("multiLine", multiline).json(path)


def decode_json(text: Column | str, schema: StructType | str) -> Column:
    """Struct parsed from JSON text; NULL fields where the text does not fit."""
    return F.from_json(text, schema)


def encode_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias(name))

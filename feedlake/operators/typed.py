"""Typing of wire rows, and the report of values that could not be typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from feedlake.schema import CORRUPT_COLUMN, TYPED_SCHEMA


def _typed(field) -> Column:
    if isinstance(field.dataType, StringType):
        return F.col(field.name)
    return F.col(field.name).try_cast(field.dataType)


def _is_bad(field) -> Column:
    return F.col(field.name).isNotNull() & _typed(field).isNull()


def _checked(schema: StructType) -> list:
    return [f for f in schema if not isinstance(f.dataType, StringType)]


def bad_value_count(schema: StructType = TYPED_SCHEMA) -> Column:
    """How many values of a wire row have no typed form."""
    count = F.lit(0)
    for field in _checked(schema):
        count = count + _is_bad(field).cast("int")
    return count


def is_corrupt(wire: DataFrame) -> Column:
    """True for a line that was no JSON object at all."""
    if CORRUPT_COLUMN not in wire.columns:
        return F.lit(False)
    return F.col(CORRUPT_COLUMN).isNotNull()


def typed_columns(schema: StructType = TYPED_SCHEMA) -> list[Column]:
    return [_typed(f).alias(f.name) for f in schema]


def typed_rows(wire: DataFrame, schema: StructType = TYPED_SCHEMA) -> DataFrame:
    """Wire rows with their declared types; a value without a typed form becomes NULL."""
    return wire.where(~is_corrupt(wire)).select(*typed_columns(schema))


def rejects(wire: DataFrame, schema: StructType = TYPED_SCHEMA) -> DataFrame:
    """One row per value that typing turned into NULL and per unreadable line.

    Columns: the row as it came, `field` (the column at fault) and `raw_value` (its text).
    """
    names = [f.name for f in schema]
    faults = [
        F.when(_is_bad(f), F.struct(F.lit(f.name).alias("field"), F.col(f.name).alias("raw_value")))
        for f in _checked(schema)
    ]
    if CORRUPT_COLUMN in wire.columns:
        faults.append(
            F.when(
                is_corrupt(wire),
                F.struct(
                    F.lit(CORRUPT_COLUMN).alias("field"), F.col(CORRUPT_COLUMN).alias("raw_value")
                ),
            )
        )
    return wire.select(*names, F.inline(F.array_compact(F.array(*faults))))

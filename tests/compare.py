"""Compare a Spark result with DuckDB's over the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    text = frame[columns].astype(object).where(frame[columns].notna(), None).map(_text)
    return sorted(map(tuple, text.itertuples(index=False)))


def _text(value) -> str:
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def same(spark_frame, sql: str, connection) -> str | None:
    """None if both give the same columns and rows, otherwise what differs."""
    relation = connection.sql(sql)
    ours, theirs = spark_frame.toPandas(), relation.df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    for name, kind in zip(relation.columns, relation.types):
        if str(kind) == "DATE":
            theirs[name] = theirs[name].map(lambda v: None if pd.isna(v) else v.date())
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    expected = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
                "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    for name, kind in spark_frame.dtypes:
        if expected[kind] != types[name]:
            return f"{name}: {kind} against {types[name]}"
        if kind in ("bigint", "int"):  # with nulls among them pandas would make floats of them
            ours[name] = ours[name].astype("Int64")
            theirs[name] = theirs[name].astype("Int64")
    left, right = _rows(ours), _rows(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return None

"""Where intermediate tables go: the shared folder that the session names for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, or its warehouse folder where it names none.

    The rule is the same for every master; both folders are ones that all executors reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/feedlake/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession, label: str = "scratch") -> str:
    """A new database whose tables live under the shared folder."""
    name = f"feedlake_{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` below the shared folder and read it back.

    What follows starts from the written files, so that it survives lost executors, sees the same
    rows every time, and is planned by the size that the files really have.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

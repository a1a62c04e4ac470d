"""Column names and types of the traffic feed, before and after typing."""

from __future__ import annotations

from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

# The feed's columns, their order and their types once loaded.
TYPED_SCHEMA = StructType(
    [
        StructField("plaza_id", StringType()),
        StructField("date", DateType()),
        StructField("hour", StringType()),
        StructField("direction", StringType()),
        StructField("vehicles_e_zpass", IntegerType()),
        StructField("vehicles_vtoll", IntegerType()),
    ]
)

# On the wire every column is text.
WIRE_SCHEMA = StructType([StructField(f.name, StringType()) for f in TYPED_SCHEMA])

# One row of the feed is one plaza, day, hour and direction.
KEY_COLUMNS = ["plaza_id", "date", "hour", "direction"]
COUNT_COLUMNS = ["vehicles_e_zpass", "vehicles_vtoll"]

# Partition column that stands in for a hidden year transform on Parquet tables.
YEAR_COLUMN = "date_year"

# Partition column that holds the number of the batch which brought a row.
BATCH_COLUMN = "load_batch"

# Column in which a JSON read keeps the text of a line it could not parse.
CORRUPT_COLUMN = "_corrupt_record"

"""What a stage holds that its declared schema does not say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.schema import WIRE_SCHEMA

# Kinds of JSON values, by the names that VARIANT has for their types.
_KINDS = {
    "STRING": "string",
    "BOOLEAN": "boolean",
    "VOID": "null",
    "OBJECT": "object",
    "ARRAY": "array",
}


def stage_drift(spark: SparkSession, stage: str, schema: StructType = WIRE_SCHEMA) -> DataFrame:
    """Fields of a JSON stage with the kinds of their values, against a declared schema.

    Columns: `field, kind, n_values, declared, conflict`: a row for each field that occurs and each
    kind of value that it has: string, number, boolean, object, array or null. `declared` says
    whether the schema has the field, `conflict` whether a declared text field has values that are
    not texts (a null is none). A declared field that no line has is a row of kind `absent` with no
    values. A line that is no JSON object is a row of field null and kind `corrupt`.

    One pass: lines are read as they are, counted in the tasks, and one row per field and kind is
    shuffled. Field names differ by case as they do in JSON. An undeclared field within an object is
    not looked into.
    """
    line = F.try_parse_json("value")
    # a text with a line that is no object has no fields
    fields = F.try_variant_get("line", "$", "map<string, variant>")
    lines = spark.read.text(stage).select(line.alias("line"), (F.trim("value") != "").alias("any"))
    each = lines.where("any").select(
        F.explode(
            F.when(fields.isNotNull(), F.map_entries(fields)).otherwise(
                F.array(
                    F.struct(
                        F.lit(None).cast("string").alias("key"),
                        F.lit(None).cast("variant").alias("value"),
                    )
                )
            )
        ).alias("entry"),
    )
    shape = F.schema_of_variant("entry.value")
    named = F.when(F.col("entry.key").isNull(), "corrupt")
    for begin, kind in _KINDS.items():
        named = named.when(shape.startswith(begin), kind)
    found = each.select(F.col("entry.key").alias("field"), named.otherwise("number").alias("kind"))
    counted = found.groupBy("field", "kind").agg(F.count("*").alias("n_values"))
    declared = spark.createDataFrame([(f.name,) for f in schema], "name string")
    joined = counted.join(declared, F.col("field") == F.col("name"), "full")
    known = F.col("name").isNotNull()
    return joined.select(
        F.coalesce("field", "name").alias("field"),
        F.coalesce("kind", F.lit("absent")).alias("kind"),
        F.coalesce("n_values", F.lit(0)).cast("long").alias("n_values"),
        known.alias("declared"),
        (known & ~F.coalesce("kind", F.lit("absent")).isin("string", "null", "absent")).alias(
            "conflict"
        ),
    )

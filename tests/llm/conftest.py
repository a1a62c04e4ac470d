import pytest
from pyspark.sql import functions as F

# null, empty and very long texts, ties, repeated rows, a row without id
LONG = " ".join(f"word{i}" for i in range(60_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (4, "one two three"),
    (5, "one two three"),
    (None, "one two three"),
    (6, LONG),
    (7, "Straße ΑΣ é 日本語 <|endoftext|> it's 12 x"),
]


@pytest.fixture
def awkward(spark):
    """Documents with every awkward value, and columns called like helpers and outputs."""
    rows = spark.createDataFrame(TEXTS, "doc_id bigint, text string").repartition(3)
    names = ["row", "class", "score", "failed_rule", "n_dropped", "start", "length", "host", "_id",
             "kept", "id", "hash", "_lines", "_host", "_day", "_hit_text", "_text_hash", "hit",
             "listed", "of_host", "text_hash", "own", "part", "word"]
    return rows.select(
        "*",
        F.lit("en").alias("lang"),
        F.lit(None).cast("string").alias("source"),
        F.lit(1).cast("bigint").alias("n_chars"),
        *[F.lit("own").alias(name) for name in names],
        F.lit("own").alias("a.b"),
    )


@pytest.fixture
def empty(awkward):
    return awkward.limit(0)

"""The corpus pipeline: each stage reads what the one before kept, and writes what it keeps."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedlake.llm.decontaminate import without_benchmark
from feedlake.llm.line_dedup import without_boilerplate
from feedlake.llm.near_duplicates import without_near_duplicates
from feedlake.llm.packing import pack, pieces
from feedlake.llm.quality import passing
from feedlake.workspace import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    A null or empty text has no words and is rejected. Repeated rows are judged each for itself.
    """
    verdict = _unused(docs, "passes")
    return passing(docs, verdict=verdict).where(f"`{verdict}`").select(*_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines. `n_chars` follows the text.

    Without a `source` column all rows are of one source, and so are rows whose source is null. A
    null text stays null. Repeated rows are each returned, and are one page of their source.
    """
    named = docs if "source" in docs.columns else docs.selectExpr("*", "'' AS source")
    dropped = _unused(named, "dropped")
    cleaned = without_boilerplate(named, dropped=dropped)
    if "n_chars" in docs.columns:
        cleaned = cleaned.selectExpr(
            *(f"`{c}`" for c in cleaned.columns if c != "n_chars"),
            f"CASE WHEN {dropped} > 0 THEN CAST(length(text) AS bigint) ELSE n_chars END AS n_chars",
        )
    return cleaned.select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Texts are linked at a similarity of 0.8, which is the rule for stages; the query `op10` has 0.85
    by its contract. Null, empty and wordless texts all stay, but for rows that repeat id and text,
    of which one stays. A row without id stays only if no linked one has an id.
    """
    return without_near_duplicates(docs).select(*_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    Null and empty texts have none and stay. Repeated rows stay or go together.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_benchmark(docs, benchmark).select(*_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of every document lies in windows of 4096 tokens.

    A null or empty text is the closing id alone. Repeated rows are each packed.
    """
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Token ids have no SQL. tests/llm/test_pipeline.py holds every stage and `run` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs

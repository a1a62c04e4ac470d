"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.copied_passages import without_copied_passages
from feedlake.llm.decontaminate import benchmark_hits
from feedlake.llm.filter_audit import filter_audit
from feedlake.llm.line_dedup import without_boilerplate
from feedlake.llm.near_duplicates import near_duplicates
from feedlake.llm.oracles import ORACLES
from feedlake.llm.packing import pack, pieces
from feedlake.llm.quality import RULES, quality_cascade
from feedlake.llm.spelling import spelling_variants
from feedlake.llm.suffix_dedup import without_repeats
from feedlake.llm.token_counts import section_tokens
from feedlake.llm.toxicity import fit, score
from feedlake.llm.url_filters import filtered_captures, host_of
from feedlake.llm.warc import archived


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document lies in windows of 4096 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packed.withColumnRenamed("crc32", "ids_crc32")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and which items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a string of 200 bytes that starts elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).drop("kept")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token belongs to the line of its first byte."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return section_tokens(docs, vocabulary, public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many of them its source repeats, and the text without them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = without_boilerplate(docs.withColumn("n_lines", F.size(F.split("text", "\n", -1))))
    return cleaned.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def _number(text: F.Column) -> F.Column:
    """A number below 65536 made of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int")


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of `pages`: two entries per host, two for the domain above it."""
    hosts = pages.select(host_of().alias("host")).where("host is not null").distinct()
    each = hosts.select("host", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    key = F.concat_ws("#", "host", F.col("k").cast("string"))
    above = F.regexp_replace("host", r"^[^.]+\.([^.]+\.)", "$1")
    return each.select(
        F.when(F.col("k") < 2, F.col("host")).otherwise(above).alias("pattern"),
        F.date_add(F.lit("2024-01-01").cast("date"), _number(key) % 365).alias("listed_on"),
        F.element_at(
            F.array(F.lit("block"), F.lit("allow"), F.lit("remove")),
            _number(F.concat(key, F.lit("!"))) % 3 + 1,
        ).alias("action"),
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every page, fetched on a day given by its id, the list entry that decides it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int"))
    captures = pages.withColumn("fetched_on", fetched)
    found = filtered_captures(captures, list_entries(pages))
    return found.select("page_id", "fetched_on", "host", "pattern", "action", "blocked")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base measures of every document, and whether the cascade of rules keeps it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_cascade(docs, RULES, measures)
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    base_failed = (words < 50) | (100 * repeated > 50 * words)
    return judged.select(
        "doc_id",
        *measures,
        base_failed.alias("base_failed"),
        F.col("failed_rule").isNull().alias("kept"),
        "failed_rule",
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives say of every page, once written and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return archived(pages, payloads=False).select(*columns)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document; a quarter of the ids is held out of the training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs.where(~held_out), labels.where(~held_out))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near duplicates that every document is in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of every order of five filters does to the documents of each language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit(docs, table(spark, sf_dir, "labels"), part="lang")


def op12_copied_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in a passage of 50 words that an earlier document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_copied_passages(docs).drop("kept")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, the more frequent word it is a variant of, and that one's root."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_warc": op8_warc,
    "op9_toxicity": op9_toxicity,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_filter_audit": op11_filter_audit,
    "op12_copied_passages": op12_copied_passages,
    "op13_spelling_variants": op13_spelling_variants,
}

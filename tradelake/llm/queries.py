"""One query per operator over its whole table, and SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (
    decontam,
    exact,
    language,
    lines,
    minhash,
    packing,
    pii,
    resampling,
    simhash,
    tokens,
    urls,
    vector_codes,
    wrappers,
)
from tradelake.llm.common import table
from tradelake.llm.oracle_sql import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048."""
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    return exact.group_copies(table(spark, sf_dir, "documents"))


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return tokens.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024
    )


@_query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside ten-word windows of the benchmark."""
    found = decontam.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    lengths = F.transform("word_spans", lambda s: s["end"] - s["start"])
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("item_ids")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, language.learn(documents))
    return found.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by fingerprints of three-word shingles."""
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the multi-line chunks that stand elsewhere."""
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


@_query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = wrappers.extract_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@_query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    documents = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(documents, pii.train(documents))
    return found.select(
        "doc_id", *(pii.counted("base", kind).alias(f"n_{kind}") for kind in pii.KINDS), F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans")
    )


@_query
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by the Jaccard similarity of their three-word shingles."""
    return minhash.near_groups(table(spark, sf_dir, "documents"))


@_query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's words and word pairs."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen bytes per vector, and their errors."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))

"""From raw documents to packed training sequences, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows
its predecessor kept; :func:`run` writes every result as Parquet below the shared
checkpoint folder and reads it back for the next stage, so that a lost
executor costs no more than its own tasks.

A stage reads ``doc_id`` and ``text``; a null in any other column, and further
columns of any name, go along as they are until the last stage.  An empty table gives
an empty table.  Texts count whole, however long.  Ties and repeated rows are
settled as each stage says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import decontam, exact, language, packing, simhash
from tradelake.llm.common import checkpointed, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of ``documents``.

    Null or empty texts and texts without a letter have none and go; a text that
    fits several languages alike stays.  Repeated rows share one fate.
    """
    return language.keep_identified(docs, language.learn(table(spark, sf_dir, "documents")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier.

    Null text counts as empty, a null identifier as the smallest; of rows that repeat
    both one stays.
    """
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest identifier.

    Texts without words are near copies of each other.  In a group without
    identifiers one row per different text stays; of rows that repeat both one does.
    """
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``benchmark``.

    Hit passages are cut out; a document with over half its words hit goes.
    Null or empty texts, and all texts if the benchmark is empty, stay as they are.
    Repeated rows are cut alike.
    """
    return decontam.cut_overlaps(docs, table(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 2048 tokens.

    Null or empty text is the end token alone.  Repeated rows are packed each for itself.
    """
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Learned statistics, automata and tokens are not expressible in SQL; the tests
# hold the result against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs

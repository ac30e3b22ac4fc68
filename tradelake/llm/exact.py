"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import checkpointed, kept_rows, text_column

# 2**(LEAF_BITS + RUN_BITS) runs at the leaves.  The first merge takes 2**LEAF_BITS
# of them at a time, RUN_BITS rounds between two partners each follow.
LEAF_BITS = 6
RUN_BITS = 6
# A run is dealt out as 2**PIECE_BITS stretches, and twice as many after each round.
PIECE_BITS = 6
# What must agree for two rows to be of one text.
TEXT = ("_digest", "_size", "_check")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    letters = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(letters)


def _stretch(bits: int) -> Column:
    """Which stretch of a sorted run a digest stands in: its first bits."""
    head = F.conv(F.hex(F.substring("_digest", 1, 3)), 16, 10).cast("int")
    return F.shiftright(head, 24 - bits)


def _merged(runs: DataFrame, meet_bits: int, piece_bits: int) -> DataFrame:
    """One sorted run for each ``2**meet_bits`` neighbouring ones.

    The partners send each stretch to one place and are sorted there by digest.
    An aggregate over a struct runs along sorted rows, so equal texts,
    neighbours in that order, become one row: the best of them and their number.
    """
    met = runs.withColumn("_run", F.shiftright("_run", meet_bits)).withColumn("_piece", _stretch(piece_bits))
    placed = met.repartition("_run", "_piece").sortWithinPartitions("_run", "_piece", *TEXT)
    return (
        placed.groupBy("_run", "_piece", *TEXT)
        .agg(F.max("_best").alias("_best"), F.sum("_n").alias("_n"))
        .drop("_piece")
    )


def group_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_bits: int = LEAF_BITS,
    run_bits: int = RUN_BITS,
) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` per row, dropped rows too.

    Texts are equal when identical after lower-casing A-Z.  Each row belongs to
    a leaf run by the hash of its identifier; a run holds its texts' SHA-256
    digests in sorted order, each once: copies are folded before they are sent.
    ``2**leaf_bits`` leaves at a time are merged, then two partners in each round,
    the distance between them doubling.  Equal digests are verified by the byte
    length and a second hash beside them, and the row with the largest identifier is
    retained.  After the last round one row per text is left.  The result goes
    back to the merged leaves and from them to the leaves, so that a join
    meets at most ``2**run_bits`` or ``2**leaf_bits`` rows per text, and at the
    leaves the rows of one run: a text that a third of all rows have is never one group.

    Null text counts as empty.  Of rows with the same identifier and text one is
    kept.  A null identifier is smaller than any other.  An empty table gives no
    rows; further columns are ignored.
    """
    rows = checkpointed(
        _digests(df, text_col).select(F.col(id_col).alias("_id"), *TEXT, F.monotonically_increasing_id().alias("_row"))
    ).withColumn("_run", F.pmod(F.xxhash64("_id", "_row"), F.lit(1 << (leaf_bits + run_bits))).cast("int"))

    leaves = checkpointed(
        rows.groupBy("_run", *TEXT).agg(F.max(F.struct("_id", "_row")).alias("_best"), F.count("*").alias("_n"))
    )
    low = checkpointed(_merged(leaves, leaf_bits, PIECE_BITS))
    top = low
    for done in range(1, run_bits + 1):
        top = _merged(top, 1, PIECE_BITS + done)

    # Down the tree: what the top settled for each merged leaf, each leaf, each row.
    settled = checkpointed(top).drop("_run")
    below = low.select("_run", *TEXT).join(settled, list(TEXT))
    below = leaves.select("_run", *TEXT).withColumn("_low", F.shiftright("_run", leaf_bits)).join(
        below.withColumnRenamed("_run", "_low"), ["_low", *TEXT]
    )
    return rows.join(below.drop("_low"), ["_run", *TEXT]).select(
        F.col("_id").alias(id_col),
        F.col("_best._id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_best._row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`group_copies` keeps, with all their columns.

    Rows are looked up among those that go (:func:`common.kept_rows`), so where these are
    few, few texts are shuffled.  Of a row that is there twice, identifier and text
    alike, one stays.
    """
    groups = group_copies(df, id_col, text_col)
    decided = groups.select(_key(F.col("text_sha256"), F.col(id_col)).alias("_key"), F.col("kept").alias("_kept"))
    # The row goes along as one value, so that its columns may have any name.
    whole = df.select(F.struct("*").alias("_whole"), df[id_col].alias("_id"), df[text_col].alias("_text"))
    keyed = _digests(whole, "_text").select("_whole", _key(F.lower(F.hex("_digest")), F.col("_id")).alias("_key"))
    return kept_rows(keyed, decided)


def _key(digest: Column, identifier: Column) -> Column:
    return F.concat_ws(":", digest, identifier.cast("string"))


def _digests(df: DataFrame, text_col: str) -> DataFrame:
    text = lower_ascii(text_column(df, text_col))
    return (
        df.withColumn("_digest", F.unhex(F.sha2(text, 256)))
        .withColumn("_size", F.octet_length(text))
        .withColumn("_check", F.xxhash64(text))
    )

"""Importance resampling towards a target distribution of hashed n-grams."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import checkpointed, field, per_text, text_column

N_BUCKETS = 10_000
MAX_N = 2
# Bytes of a text that are words in memory at once.
PART_BYTES = 4 << 20

_UPPER, _LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
_KEPT = (string.digits + string.ascii_letters).encode() + bytes(range(0x80, 0x100))
# Lower-cases A-Z; every ASCII byte that is no letter and no digit becomes a blank.
TABLE = bytes(b if b in _KEPT else 0x20 for b in range(256)).translate(bytes.maketrans(_UPPER, _LOWER))


def word_parts(text: str, most: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time."""
    data = text.encode().translate(TABLE)
    start = 0
    while len(data) - start > most:
        # Cut behind a blank; a longer word stays whole.
        end = data.rfind(b" ", start, start + most) + 1 or data.find(b" ", start + most) + 1 or len(data)
        yield data[start:end].split()
        start = end
    yield data[start:].split()


def feature_parts(text: str, n_buckets: int, max_n: int, most: int = PART_BYTES) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Number of words, and the buckets of the 1- to ``max_n``-grams that end there, per part.

    An n-gram's checksum goes on from that of the n-1 words before its last word,
    so that no n-gram is ever joined.
    """
    # ends[k]: checksums of the k+1 words that end at each word of the part; at first of the last part's end.
    ends: list[list[int]] = [[] for _ in range(max_n)]
    for words in word_parts(text, most):
        if not words:
            continue
        spaced = [b" " + w for w in words]
        runs = [list(map(crc32, words))]
        found = [np.array(runs[0], np.int64) % n_buckets]
        for k in range(1, max_n):
            seeds = ends[k - 1] + runs[k - 1]
            # Seeds one word earlier; the first words of a text have fewer before them.
            grams = list(map(crc32, spaced[len(spaced) + 1 - len(seeds) :], seeds))
            runs.append(grams)
            found.append(np.array(grams, np.int64) % n_buckets)
        ends = [r[-1:] or e for r, e in zip(runs, ends)]
        yield len(words), found


def bucket_counts(df: DataFrame, text_col: str, n_buckets: int, max_n: int) -> np.ndarray:
    """How often each bucket's features stand in all texts.

    Every task counts its whole share first, so that at most ``n_buckets`` rows
    leave it, and as many reach the driver.
    """
    schema = T.StructType([field("bucket", "bigint"), field("n", "bigint")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_parts(text.as_py(), n_buckets, max_n):
                    for buckets in found:
                        counts.update(buckets.tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], schema.names
        )

    rows = df.select(text_column(df, text_col).alias("text")).mapInArrow(run, schema)
    out = np.zeros(n_buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))`` per bucket, B the number of buckets."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    gains = [np.floor(1000 * log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in pairs]
    return np.array(gains, np.int64)


def weigh(df: DataFrame, gains: np.ndarray, id_col: str, text_col: str, max_n: int) -> DataFrame:
    """``id, n_words, n_features, weight``: the floored mean gain of a text's features, 0 without any."""

    def weight(text: str) -> tuple[int, int, int]:
        words = features = total = 0
        for n, found in feature_parts(text, len(gains), max_n):
            words += n
            for buckets in found:
                features += len(buckets)
                total += int(gains[buckets].sum())
        return words, features, total // features if features else 0

    def make():
        return lambda texts: list(zip(*map(weight, texts)))

    fields = [field(c, "bigint") for c in ("n_words", "n_features", "weight")]
    return per_text(df, [text_col], fields, make, kept=[id_col])


def gumbel(identifier: Column, seed: int) -> Column:
    """Noise that depends on the identifier alone: ``floor(-1000 ln(-ln u))``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(-1000 * F.ln(-F.ln(u))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``_rank``, 1, 2, 3... in the order given.

    A range shuffle and a sort in each part; the parts' sizes, one number each, are
    all that reaches the driver.  No row passes a single task.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(parts.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, {}
    for p in sorted(sizes):
        starts[p], before = before, before + sizes[p]
    if not starts:
        return placed.select(*rows.columns, F.lit(0).cast("bigint").alias("_rank"))
    offset = F.create_map(*(F.lit(x).cast("bigint") for pair in starts.items() for x in pair))[part]
    in_part = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*rows.columns, (offset + in_part + 1).alias("_rank"))


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = 25,
    min_words: int = 20,
    n_buckets: int = N_BUCKETS,
    max_n: int = MAX_N,
    seed: int = 7,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` per row; those drawn have a rank.

    Words are what stands between ASCII characters that are no letters or
    digits, A-Z lower-cased; features are all runs of 1 to ``max_n`` words, by the
    checksum of their bytes in ``n_buckets`` buckets.  A row's weight is the mean of its
    features' gains: by how much commoner (thousandths of a natural logarithm) their
    buckets are in ``target`` than in ``df``.  ``score`` adds Gumbel noise fixed by
    the identifier, so that the highest scores are a draw without replacement in
    proportion to the weights.  Of N rows with at least ``min_words`` words the
    ``floor(percent * N / 100)`` highest are drawn and numbered, ties to the
    smaller identifier.

    Null or empty texts have no features, weight 0 and are never drawn.  A null
    identifier counts as the empty text in the noise and as larger than any other in
    ties.  Repeated rows score alike and each has a place of its own; which of them
    comes first is left open.  Texts of any length count whole, a bounded part in
    memory beside the text.  An empty table gives no rows, an empty target has no
    features; further columns are ignored.
    """
    gains = bucket_gains(
        bucket_counts(df, text_col, n_buckets, max_n), bucket_counts(target, target_col, n_buckets, max_n)
    )
    weighed = weigh(df, gains, id_col, text_col, max_n)
    rows = checkpointed(
        weighed.select(
            F.col(id_col).alias("_id"),
            "n_words",
            "n_features",
            "weight",
            (F.col("weight") + gumbel(F.col(id_col), seed)).alias("score"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    fit = F.col("n_words") >= min_words
    drawn = rows.where(fit).count() * percent // 100
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_row").asc()]
    columns = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    rank = F.when(F.col("_rank") <= drawn, F.col("_rank")).alias("rank")
    placed = ranked(rows.where(fit), order).select(*columns, rank)
    return placed.unionByName(rows.where(~fit).select(*columns, F.lit(None).cast("bigint").alias("rank")))

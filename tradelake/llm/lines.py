"""Line dedup by content-defined chunks of lines, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import checkpointed, text_column

# Line hashes are numbers below 16**HEX.
HEX = 12
# Lines that a rolling hash covers; shorter repeats stay.
MIN_LINES = 2


def _held(column: Column) -> Column:
    """The value computed once: what reads it cannot be merged with what makes it."""
    return F.explode(F.array(column))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, HEX), 16, 10).cast("long")


def _rolled(df: DataFrame, text_col: str, kept: list[Column], size: int) -> DataFrame:
    """``kept``, ``_start`` and ``_hash`` per place: the rolling hash of ``size`` lines from there on.

    It depends on these lines only, and is found again wherever they stand.
    """
    lines = df.select(*kept, F.split(text_column(df, text_col), "\n", -1).alias("_lines"))
    hashes = lines.select(*lines.columns[:-1], _held(F.transform("_lines", _line_hash)).alias("_hashes"))
    places = F.when(
        F.size("_hashes") >= size,
        F.transform(
            F.sequence(F.lit(1), F.size("_hashes") - (size - 1)), lambda i: F.xxhash64(F.slice("_hashes", i, size))
        ),
    )
    return hashes.select(*lines.columns[:-1], F.posexplode(places).alias("_start", "_hash"))


def _covered(starts: str, size: int) -> Column:
    """The lines that windows beginning at ``starts`` cover, each once."""
    return F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (size - 1)))))


def _runs(lines: str) -> Column:
    """Ascending line numbers as runs (``_start``, ``_stop``; end exclusive)."""
    at = lambda k: F.try_element_at(lines, k)
    begins = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda k: (k == 1) | (at(k) - at(F.greatest(k - 1, F.lit(1))) > 1))
    ends = F.concat(F.slice(begins, 2, F.size(begins)), F.array(F.size(lines) + 1))
    return F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda r: F.struct(at(r["b"]).alias("_start"), (at(r["e"] - 1) + 1).alias("_stop")),
    )


def _key(df: DataFrame, id_col: str, text_col: str) -> Column:
    return F.concat_ws(":", F.md5(text_column(df, text_col)), df[id_col].cast("string"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """``id, n_lines, n_removed_lines, n_removed_chunks, text`` per row.

    A hash rolls over every ``min_lines`` neighbouring lines.  Boundaries lie where it is found nowhere else:
    between them are the chunks whose neighbouring lines stand together in another place too, wherever
    that begins and ends.  Of such lines only the place with the smallest identifier (then the first in
    the text) stays, with all its lines; the others go, and a run of lines that go is a removed
    chunk.  Hashes that are found again are compared by the bytes of their lines before any is removed.

    Only hashes are shuffled to find what is repeated, summed up in each task
    first, so that lines which a third of all documents have are no large group.
    Texts are shuffled once by document, to compare bytes of repeated lines and
    to remove them.

    Null text counts as empty: one empty line.  Rows that repeat identifier and
    text count as one document and give equal results.  A null identifier is
    smaller than any other.  An empty table gives no rows; further columns are
    ignored.
    """
    key = _key(df, id_col, text_col).alias("_key")
    identifier = F.col(id_col).alias("_id")
    rolled = checkpointed(_rolled(df, text_col, [key], min_lines))
    again = checkpointed(rolled.groupBy("_hash").count().where("count > 1").drop("count"))
    # Rows that repeat identifier and text have the same places.
    suspects = checkpointed(
        rolled.join(again, "_hash", "left_semi").groupBy("_key").agg(F.collect_set("_start").alias("_starts"))
    )

    # The bytes of the suspects; one row per different lines and task goes on.  This and the rest is one
    # plan without rows written between, so that all its joins read the same shuffle of the texts.
    texts = df.select(key, identifier, text_column(df, text_col).alias("_text"))
    compared = (
        texts.join(suspects, "_key")
        .select("_key", "_id", F.split("_text", "\n", -1).alias("_lines"), "_starts")
        .select("_key", "_id", "_lines", F.explode("_starts").alias("_start"))
        .select(
            F.struct("_id", "_key", "_start").alias("_place"),
            F.array_join(F.slice("_lines", F.col("_start") + 1, min_lines), "\n").alias("_bytes"),
        )
    )
    compared = compared.withColumn("_digest", F.sha2("_bytes", 256))
    same = (
        compared.groupBy("_digest", "_bytes")
        .agg(F.min("_place").alias("_first"), F.count("*").alias("_count"))
        .where("_count > 1")
        .select("_digest", "_first")
    )
    first = F.col("_place") == F.col("_first")
    start = F.col("_place._start")
    placed = compared.drop("_bytes").join(same, "_digest").groupBy(F.col("_place._key").alias("_key")).agg(
        F.collect_set(F.when(first, start)).alias("_stay"), F.collect_set(F.when(~first, start)).alias("_go")
    )
    lines = F.array_sort(F.array_except(_covered("_go", min_lines), _covered("_stay", min_lines)))
    removed = (
        placed.select("_key", _held(lines).alias("_at")).where(F.size("_at") > 0).select("_key", _runs("_at").alias("_gone"))
    )
    joined = (
        texts.join(removed, "_key", "left")
        .withColumn("_lines", F.split("_text", "\n", -1))
        .withColumn("_m", F.coalesce(F.size("_gone"), F.lit(0)))
    )
    return _without(joined, id_col)


def _without(joined: DataFrame, id_col: str) -> DataFrame:
    """The lines between the removed ranges, from the first line to the last."""
    size = F.size("_lines")

    def gap(j: Column) -> Column:
        start = F.when(j == 0, F.lit(0)).otherwise(F.try_element_at("_gone", j)["_stop"])
        stop = F.when(j == F.col("_m"), size).otherwise(F.try_element_at("_gone", j + 1)["_start"])
        return F.slice("_lines", start + 1, stop - start)

    gaps = F.flatten(F.transform(F.sequence(F.lit(0), F.col("_m")), gap))
    kept = F.when(F.col("_m") > 0, gaps).otherwise(F.col("_lines"))
    held = joined.select("_id", "_m", size.cast("long").alias("n_lines"), _held(kept).alias("_kept"))
    return held.select(
        F.col("_id").alias(id_col),
        "n_lines",
        (F.col("n_lines") - F.size("_kept")).alias("n_removed_lines"),
        F.col("_m").cast("long").alias("n_removed_chunks"),
        F.array_join("_kept", "\n").alias("text"),
    )

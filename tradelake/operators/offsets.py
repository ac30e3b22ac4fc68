"""Offsets that a table lacks or has more than once, per topic partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PLACE = ("kafka_topic", "kafka_partition")
# Offsets that one task looks at in order.
BLOCK = 1 << 20


def _once(records: DataFrame, place: tuple[str, ...], offset: str) -> DataFrame:
    """Offsets with the number of their messages, folded map-side."""
    known = records.where(F.col(offset).isNotNull())
    return known.groupBy(*place, offset).agg(F.count("*").alias("_n"))


def offset_gaps(
    records: DataFrame, place: tuple[str, ...] = PLACE, offset: str = "kafka_offset", block: int = BLOCK
) -> DataFrame:
    """``gap_start, gap_end, missing``: runs of offsets between a partition's first and last that are not there.

    ``records`` has one row per message, or any rows that name their message.  Inside blocks of
    ``block`` offsets neighbours are compared; between blocks only their first and last
    offsets are, so no topic partition, however hot, is gathered in one task.
    """
    blocked = _once(records, place, offset).withColumn("_block", F.floor(F.col(offset) / block))
    inside = Window.partitionBy(*place, "_block").orderBy(offset)
    near = blocked.select(*place, F.lag(offset).over(inside).alias("_before"), F.col(offset).alias("_at"))
    edges = blocked.groupBy(*place, "_block").agg(F.min(offset).alias("_at"), F.max(offset).alias("_last"))
    between = Window.partitionBy(*place).orderBy("_block")
    far = edges.select(*place, F.lag("_last").over(between).alias("_before"), "_at")
    gaps = near.unionByName(far).where(F.col("_at") - F.col("_before") > 1)
    return gaps.select(
        *place,
        (F.col("_before") + 1).alias("gap_start"),
        (F.col("_at") - 1).alias("gap_end"),
        (F.col("_at") - F.col("_before") - 1).alias("missing"),
    )


def offset_report(
    records: DataFrame, place: tuple[str, ...] = PLACE, offset: str = "kafka_offset", block: int = BLOCK
) -> DataFrame:
    """Per topic partition: first and last offset, messages, those that came again, gaps and offsets missing."""
    seen = _once(records, place, offset).groupBy(*place).agg(
        F.min(offset).alias("first_offset"),
        F.max(offset).alias("last_offset"),
        F.count("*").alias("messages"),
        F.sum(F.col("_n") - 1).alias("repeats"),
    )
    gaps = offset_gaps(records, place, offset, block).groupBy(*[F.col(c).alias(f"_{c}") for c in place]).agg(
        F.count("*").alias("gaps"), F.sum("missing").alias("missing")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    found = seen.join(gaps, same, "left").drop(*[f"_{c}" for c in place])
    return found.fillna(0, ["gaps", "missing"])

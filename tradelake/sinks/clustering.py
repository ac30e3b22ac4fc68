"""Files whose value ranges overlap little, so that scans skip most of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges that each column of an interleaved key is cut into: 2**RANGE_BITS.
RANGE_BITS = 6


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows dealt out and sorted by ``columns``: neighbours stand in one file.

    A row group's least and greatest values then cover a short range of the first columns, and
    a scan with bounds on them skips the others.  ``files`` fixes the number of parts; else
    adaptive execution sizes them.  A value that many rows share may fill several files if
    further columns tell those rows apart.
    """
    order = [F.col(c) for c in columns]
    parts = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return parts.sortWithinPartitions(*order)


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANGE_BITS, accuracy: int = 10_000) -> dict[str, list]:
    """Per column up to ``2**bits - 1`` bounds that cut its values into ranges of about as many rows.

    Quantile sketches, merged from all tasks: a fixed number of values reaches the driver.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def interleaved(columns: Sequence[str], bounds: dict[str, list], bits: int = RANGE_BITS) -> Column:
    """One number from the range numbers of several columns, their bits in turn.

    Rows near each other in all columns have near numbers, so a bound on any one of them skips
    files, not only one on the first.  Columns are numbers, dates or times; null comes first.
    """
    ranks = []
    for c in columns:
        value = F.col(c).cast("double")
        over = [F.when(value >= b, 1).otherwise(0) for b in bounds[c]]
        ranks.append(reduce(lambda a, b: a + b, over, F.lit(0)).cast("bigint"))
    places = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(columns) + len(columns) - 1 - i)
        for i, rank in enumerate(ranks)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), places)


def z_clustered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = RANGE_BITS) -> DataFrame:
    """:func:`clustered` by the interleaved key of ``columns``."""
    keyed = df.withColumn("_z", interleaved(columns, range_bounds(df, columns, bits), bits))
    return clustered(keyed, ["_z", *columns], files).drop("_z")

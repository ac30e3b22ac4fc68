"""Subscription check against a table of listed symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.symbols import passes_without_listing


def known_symbols(trades: DataFrame, listed: DataFrame, column: str = "symbol") -> DataFrame:
    """Trades of symbols that need no lookup or are in ``listed``.

    No broadcast hint: Spark broadcasts the list when its measured size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and else sort-merges, where
    adaptive execution splits a hot symbol's rows over several tasks.
    """
    names = listed.select(F.col(column).alias("_listed")).distinct()
    marked = trades.join(names, F.col(column) == F.col("_listed"), "left")
    keep = passes_without_listing(F.col(column)) | F.col("_listed").isNotNull()
    return marked.where(keep).drop("_listed")


def unknown_symbols(trades: DataFrame, listed: DataFrame, column: str = "symbol") -> DataFrame:
    """The rest; only symbols that need a lookup enter the join."""
    lookups = trades.where(~passes_without_listing(F.col(column)))
    return lookups.join(listed.select(column).distinct(), column, "left_anti")

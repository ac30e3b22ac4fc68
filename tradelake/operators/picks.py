"""First or last row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake import constants as C
from tradelake.operators.candles import TIE_BREAK, tumbling


def first_per_group(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """The first whole row per group.

    ``row_number() = 1`` makes Spark keep one row per group *before* the
    shuffle (WindowGroupLimit), so no group is gathered in one task.
    """
    numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where("_n = 1").drop("_n")


def _edge_trades(trades, interval, at, tie_break, descending: bool) -> DataFrame:
    columns = [F.col(c) for c in (at, *tie_break)]
    order = [c.desc() if descending else c.asc() for c in columns]
    return first_per_group(tumbling(trades, interval, at), ["symbol", "exchange", "w"], order)


def first_trades(
    trades: DataFrame,
    interval: str = "1 hour",
    *,
    at: str = "trade_datetime",
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """The opening trade of each symbol, exchange and window ``w``."""
    return _edge_trades(trades, interval, at, tie_break, descending=False)


def last_trades(
    trades: DataFrame,
    interval: str = "1 hour",
    *,
    at: str = "trade_datetime",
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """The closing trade of each symbol, exchange and window ``w``."""
    return _edge_trades(trades, interval, at, tie_break, descending=True)


def dedupe_trades(
    trades: DataFrame,
    keys: Sequence[str] = C.SOURCE_KEY,
    prefer: Sequence[str] = ("bronze_ingestion_timestamp",),
) -> DataFrame:
    """One row per source key, the one smallest in ``prefer``.

    Copies are dropped map-side first: a trade delivered a billion times sends
    one row per task through the shuffle.
    """
    return first_per_group(trades, list(keys), [F.col(c).asc() for c in prefer])

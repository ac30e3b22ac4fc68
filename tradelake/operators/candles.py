"""Time-window OHLCV candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.identity import packed_order_key
from tradelake.schemas import CANDLES

GROUP = ("symbol", "exchange", "base_currency", "quote_currency")
TIE_BREAK = ("kafka_partition", "kafka_offset", "trade_index")


def tumbling(trades: DataFrame, interval: str = "1 hour", at: str = "trade_datetime") -> DataFrame:
    """Add ``w``, the epoch-aligned window; rows without a time belong to none."""
    return trades.withColumn("w", F.window(F.col(at), interval))


def candles(
    trades: DataFrame,
    interval: str = "1 hour",
    *,
    at: str = "trade_datetime",
    tie_break: Sequence[str] = TIE_BREAK,
    clock: Column | None = None,
) -> DataFrame:
    """Open, high, low, close, volume, count, mean, VWAP and change per symbol
    and window.

    A single hash aggregate: each task folds its rows to one row per group
    before the only shuffle, so a symbol holding most of the trades costs the
    shuffle no more than a rare one.  Open and close are the prices at the
    smallest and largest (time, *tie_break).
    """
    in_window = F.unix_millis(at) - F.unix_millis("w.start")
    price, volume, order = F.col("price"), F.col("volume"), F.col("_order")
    grouped = (
        tumbling(trades, interval, at)
        .withColumn("_order", packed_order_key(in_window, tie_break))
        .groupBy(*GROUP, "w")
        .agg(
            F.min_by(price, order).alias("open_price"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(price, order).alias("close_price"),
            F.sum(volume).alias("total_volume"),
            F.count("*").alias("trade_count"),
            F.avg(price).alias("avg_price"),
            vwap(price, volume).alias("vwap"),
        )
    )
    return _finished(grouped, clock)


def _finished(grouped: DataFrame, clock: Column | None) -> DataFrame:
    opened, closed = F.col("open_price"), F.col("close_price")
    return grouped.withColumns(
        {
            "hour_start": F.col("w.start"),
            "hour_end": F.col("w.end"),
            "price_change": closed - opened,
            "price_change_pct": (F.try_divide(closed, opened) - 1) * 100,
            "agg_date": F.to_date("w.start"),
            "silver_ingestion_timestamp": F.current_timestamp() if clock is None else clock,
        }
    ).select(*CANDLES.schema.names)


# Buffers of the aggregates above as the state of a stream keeps them, in their
# order; sums that two aggregates share are there once.
_BUFFERS = """struct<open_price:double, open_key:decimal(38,0), high_price:double, low_price:double,
    close_price:double, close_key:decimal(38,0), total_volume:double, trade_count:bigint,
    price_sum:double, priced:bigint, paid:double>"""


def candles_of_state(state: DataFrame, clock: Column | None = None) -> DataFrame:
    """The candles of a stream's unfinished windows from ``key`` and ``value`` of its stored state."""
    buffers = state.select("key.*", F.col("value").cast(_BUFFERS).alias("v"))
    grouped = buffers.select(*GROUP, "w", "v.*").withColumns(
        {
            "avg_price": F.try_divide(F.col("price_sum"), F.col("priced")),
            "vwap": F.try_divide(F.col("paid"), F.col("total_volume")),
        }
    )
    return _finished(grouped, clock)


def vwap(price: Column, volume: Column) -> Column:
    """Volume-weighted mean price; null when no volume was traded."""
    return F.try_divide(F.sum(price * volume), F.sum(volume))


def window_counts(trades: DataFrame, interval: str, at: str = "trade_datetime") -> DataFrame:
    """Trades per window."""
    return (
        tumbling(trades, interval, at)
        .groupBy("w")
        .agg(F.count("*").alias("trade_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "trade_count")
    )
